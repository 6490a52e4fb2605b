"""The operators of this package on the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.batches import prepare
from millrace.sources.load import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op6_token_counts")
def op6(spark, folder):
    from millrace.llm.token_counts import op6_token_counts

    return op6_token_counts(spark, table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op7_language")
def op7(spark, folder):
    from millrace.llm.language import op7_language

    return op7_language(table(spark, folder, "documents"))


@query("op9_quality")
def op9(spark, folder):
    from millrace.llm.quality import op9_quality

    return op9_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_simhash")
def op10(spark, folder):
    from millrace.llm.simhash import op10_simhash

    return op10_simhash(table(spark, folder, "documents"))


@query("op1_sharding")
def op1(spark, folder):
    from millrace.llm.sharding import op1_shards

    return op1_shards(table(spark, folder, "documents"))


@query("op4_bpe")
def op4(spark, folder):
    from millrace.llm.bpe import op4_bpe

    return op4_bpe(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op3_decontaminate")
def op3(spark, folder):
    from millrace.llm.decontaminate import op3_decontaminate

    return op3_decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op8_pii")
def op8(spark, folder):
    from millrace.llm.pii import op8_pii

    return op8_pii(table(spark, folder, "documents"))


@query(
    "op2_embeddings",
    """WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding,
        lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e)
        / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(least(vec_id, m.b), vec_id) AS component_id,
      coalesce(vec_id = least(vec_id, m.b), true) AS kept
    FROM embeddings LEFT JOIN counts c ON c.a = vec_id LEFT JOIN least m ON m.a = vec_id""",
)
def op2(spark, folder):
    from millrace.llm.embedding_dups import op2_embeddings

    return op2_embeddings(table(spark, folder, "embeddings"))


@query("op5_suffix_dedup")
def op5(spark, folder):
    from millrace.llm.suffix_dedup import op5_suffix_dedup

    return op5_suffix_dedup(table(spark, folder, "documents"))


@query(
    "op11_fill_middle",
    """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
      regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
    d AS (SELECT *, len(units) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS x,
      CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS y, text = '' OR contains(text, '<P>') OR contains(text, '<S>')
      OR contains(text, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 AS plain,
      CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 AS suffix_first FROM t),
    c AS (SELECT *, array_to_string(units[1:least(x, y)], '') AS p, array_to_string(units[least(x, y) + 1:greatest(x, y)], '') AS m,
      array_to_string(units[greatest(x, y) + 1:n], '') AS s FROM d)
    SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
      CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
      sha256(CASE WHEN plain THEN text WHEN suffix_first THEN '<S>' || s || '<P>' || p || '<M>' || m
        ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
      sha256(text) AS restored_sha256 FROM c""",
)
def op11(spark, folder):
    from millrace.llm.fill_middle import op11_fill_middle

    return op11_fill_middle(table(spark, folder, "documents"))


@query("op12_whitening")
def op12(spark, folder):
    from millrace.llm.whitening import op12_whitening

    return op12_whitening(table(spark, folder, "embeddings"))


@query("op13_fingerprints")
def op13(spark, folder):
    from millrace.llm.fingerprints import op13_fingerprints

    return op13_fingerprints(table(spark, folder, "documents"))
