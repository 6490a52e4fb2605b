import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import pii, simhash

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(sp, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    docs = sp.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(sp, docs, FOLDER).write.parquet(f"{folder}/{k}")
        docs = sp.read.parquet(f"{folder}/{k}")
        found.append(docs)
    return found


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    for docs in stages[1:-1]:
        assert docs.dtypes == stages[0].dtypes
    assert stages[-1].columns == [*stages[0].columns, "n_tokens", "ids_sha256", "decoded_sha256"]


def test_good_documents_pass_the_classifier(sp, stages):
    kept = by_id(stages[1])
    labels = sp.read.parquet(f"{FOLDER}/labels.parquet").collect()
    good = [r.doc_id for r in labels if r.quality == 1 and not r.toxic]
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert sum(r.doc_id in kept for r in labels if r.quality == 0) <= 0.2 * sum(r.quality == 0 for r in labels)


def test_one_document_of_each_group(stages):
    before = by_id(stages[1])
    prints = {i: simhash.fingerprint(r.text.encode(), 4, 42) for i, r in before.items()}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if bin(prints[a] ^ prints[b]).count("1") <= 4:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert set(by_id(stages[2])) == {i for i in ids if find(i) == i}


def test_no_benchmark_passage_is_left(sp, stages):
    items = [r.text for r in sp.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before, after = by_id(stages[2]), by_id(stages[3])
    assert set(after) == {i for i, r in before.items() if not any(t in r.text for t in items)}


def test_personal_data_is_replaced(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and not pii.base_spans(r.text)[0]
        if not re.search("[0-9@]", before[i].text):
            assert r.text == before[i].text


def test_tokens(stages):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(corpus_pipeline.tokenizer_path(corpus_pipeline.VOCABULARY))
    for r in stages[5].collect():
        assert r.n_tokens == len(library.encode(r.text, add_special_tokens=False).ids)


def test_run_and_registration(sp, stages):
    rows = sorted((r.doc_id, r.ids_sha256) for r in entry.queries()["pipeline"](sp, FOLDER).collect())
    assert rows == sorted((r.doc_id, r.ids_sha256) for r in stages[5].collect())
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_stages_take_nulls_and_empty_tables(sp, docs, no_docs):
    """What each stage makes of nulls, blanks, repeated rows and ids, and a very long text."""
    texts = lambda found: sorted((r.doc_id or -1, r.text, r.lang or "", r.source) for r in found if r.text)
    result = {}
    for name, stage in corpus_pipeline.STAGES:
        result[name] = stage(sp, docs, FOLDER).collect()
        assert stage(sp, no_docs, FOLDER).collect() == []
    assert {r.doc_id for r in result["quality classifier"]} <= {r.doc_id for r in docs.collect()}
    singles = sorted((r.doc_id is None, r.doc_id, r.text or "") for r in result["SimHash near-dedup"] if r.doc_id is not None)
    assert [(i, t[:9]) for _, i, t in singles] == [(1, "The first"), (2, ""), (5, "The long "), (6, "Über die "), (7, "one id"), (7, "two texts"), (9, "xxxxxxxxx")]
    assert sum(r.doc_id is None for r in result["SimHash near-dedup"]) == 2
    for name in ("benchmark decontamination", "PII"):
        assert texts(result[name]) == texts(docs.collect())
        assert sorted(map(str, (r.text for r in result[name] if not r.text))) == ["", "None"]
    tokens = {(r.doc_id, r.text): r.n_tokens for r in result["BPE encoding and decoding"]}
    assert len(result["BPE encoding and decoding"]) == 12 and tokens[2, None] == tokens[3, ""] == 0 and all(tokens[k] for k in tokens if (k[1] or "").strip())


def test_a_stage_is_written_before_the_next(sp, monkeypatch):
    """Every stage reads files, not the plans of the stages before."""
    seen = []

    def counting(name, stage):
        def run(spark, docs, sf_dir):
            seen.append((name, [f.rsplit("/", 2)[-2] for f in docs.inputFiles()][:1]))
            return stage(spark, docs, sf_dir)

        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [counting(*s) for s in corpus_pipeline.STAGES])
    corpus_pipeline.run(sp, FOLDER)
    assert [at for _, at in seen[1:]] == [["0"], ["1"], ["2"], ["3"]]
