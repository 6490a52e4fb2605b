"""BPE encoding and decoding as streaming transducers.

The encoder reads a word byte by byte. For every prefix it knows the last token of that prefix's
encoding: an encoding is right exactly if every token is its own encoding and every two neighbours
stay apart when the two are encoded together, so the token that ends a prefix is the one that is
compatible with the encoding before it. What a later byte can still change reaches back over a bounded
distance, the lookahead that follows from the merge list; tokens on which all prefixes that may
still be continued agree are stable and leave at once. The buffer thus stays below a constant,
whatever the length of the word.

The decoder is a state machine from token bytes to text that keeps an unfinished character between calls.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from millrace.llm.batches import appended, fresh, over_batches, text_of, with_columns

#: Words whose tokens a worker remembers, and pairs of tokens known to stay apart or not.
REMEMBERED, PAIRS = 150_000, 150_000
#: Characters of a text that are handled at once; a longer one is cut before white space.
PIECE = 1 << 20
#: Bytes of a word after which stable tokens are looked for.
STRIDE = 256
#: The time of what no rule ends.
NEVER = 1 << 40


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: itself, or the next free character from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def sufficient_lookahead(merges: Iterable[tuple[bytes, bytes]]) -> int:
    """Bytes beyond which nothing changes a token any more.

    A change travels back from the end of the text over applications of merge rules, each of a
    later rule than the one before, and each no longer than the longest token. So rules times longest token
    suffice for any merge list whose rules only use what earlier rules made.
    """
    sizes = [len(a) + len(b) for a, b in merges]
    return len(sizes) * max(sizes, default=1)


class Vocabulary:
    """Merge list and ids of a byte-level BPE file, with an end-of-word suffix or without."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.normalizers = [n for n in _listed(spec["normalizer"], "normalizers")]
        splits = [p for p in _listed(spec["pre_tokenizer"], "pretokenizers") if p["type"] == "Split"]
        known = {"NFC", "Replace", "Lowercase"}
        if not {n["type"] for n in self.normalizers} <= known or len(splits) != 1 or not splits[0]["invert"]:
            raise ValueError(f"{path}: only {sorted(known)} and one inverted split are supported")
        self.words = regex.compile(splits[0]["pattern"]["Regex"])
        # White space replaced by a blank stays outside of words that hold none: nothing to do.
        needless = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        if r"[^\s" in self.words.pattern and self.words.search(" \t\n") is None:
            self.normalizers = [n for n in self.normalizers if n != needless]
        self.replaced = [(regex.compile(n["pattern"]["Regex"]), n["content"]) for n in self.normalizers if n["type"] == "Replace"]
        self.text_of_id = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.specials.items()}
        self.back = {c: b for b, c in byte_alphabet().items()}
        self.ranks: dict[tuple[str, str], int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[a, b] = rank

    def raw(self, token: str) -> bytes:
        """The bytes a token stands for, without the suffix."""
        return bytes(self.back[c] for c in token.removesuffix(self.suffix) if c in self.back)

    def normalized(self, text: str) -> str:
        for n in self.normalizers:
            if n["type"] == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif n["type"] == "Lowercase":
                # Character by character: a final sigma is lowered like any other.
                text = text.replace("Σ", "σ").lower()
            else:
                pattern, content = next(x for x in self.replaced if x[0].pattern == n["pattern"]["Regex"])
                text = pattern.sub(content, text)
        return text


def _endings(tokens: dict[bytes, int]) -> dict[bytes, int]:
    found = {t[i:]: -1 for t in tokens for i in range(len(t))}
    return found | tokens


def _listed(part: dict | None, key: str) -> list[dict]:
    return [] if part is None else part[key] if part["type"] == "Sequence" else [part]


class Encoder:
    """The transducer of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.lookahead = sufficient_lookahead((vocabulary.raw(a), vocabulary.raw(b)) for a, b in vocabulary.ranks)
        self.alphabet = byte_alphabet()
        suffix, raw = vocabulary.suffix, vocabulary.raw
        #: Tokens by their bytes: those inside a word, and those that end one.
        inner: dict[bytes, int] = {}
        final: dict[bytes, int] = {}
        for token, i in vocabulary.ids.items():
            if not suffix or token.endswith(suffix):
                final[raw(token)] = i
            if not suffix or not token.endswith(suffix):
                inner[raw(token)] = i
        # Only what encodes to itself can end a prefix.
        inner = {b: i for b, i in inner.items() if self._merged(b, False) == [vocabulary.text_of_id[i]]}
        final = {b: i for b, i in final.items() if self._merged(b, True) == [vocabulary.text_of_id[i]]}
        self.longest = max(map(len, [*inner, *final]))
        self.apart: dict[int, bool] = {}
        self.spines: dict[tuple[int, bool], list[tuple[str, int]]] = {}
        #: Where the rule that makes a token joins it.
        whole = {t: t for t in vocabulary.ids}
        self.cut = {whole.get(a + b, a + b): len(a) for a, b in vocabulary.ranks}
        vocabulary.ids = {}  # from here on tokens are looked up by their bytes
        #: Every ending of a token, with the token it is, if any.
        self.inner_endings = _endings(inner)
        self.final_endings = _endings(final)
        self.remembered: dict[str, bytes] = {}

    def forget(self) -> None:
        """Empties what is remembered of words and pairs, so that an idle worker holds the vocabulary alone."""
        self.remembered.clear()
        self.apart.clear()
        self.spines.clear()

    def _merged(self, data: bytes, ends: bool) -> list[str]:
        """The definition of the encoding: the earliest rule that applies anywhere is applied, from the left."""
        parts = [self.alphabet[b] for b in data]
        if ends and parts:
            parts[-1] += self.vocabulary.suffix
        return self._settled(parts)

    def _settled(self, parts: list[str]) -> list[str]:
        ranks = self.vocabulary.ranks
        while len(parts) > 1:
            best, at = min(((ranks.get(pair, 1 << 30), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False))))
            if best == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _spine(self, token: int, right: bool) -> list[tuple[str, int]]:
        """What stands at one edge of a token while it forms: each symbol and the rule that ends its time."""
        known = self.spines.get((token, right))
        if known is None:
            names, ranks, suffix = self.vocabulary.text_of_id, self.vocabulary.ranks, self.vocabulary.suffix
            symbol, until, known = names[token], NEVER, []
            while True:
                known.append((symbol, until))
                length = len(symbol.removesuffix(suffix)) if suffix else len(symbol)
                if length == 1:
                    break
                until = ranks[symbol[: self.cut[symbol]], symbol[self.cut[symbol] :]]
                symbol = symbol[self.cut[symbol] :] if right else symbol[: self.cut[symbol]]
            known = self.spines[token, right] = known[::-1]
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether the two tokens, encoded together, are the same two tokens.

        Follows the symbols on both sides of the border through time. They would merge if their rule
        comes before the next one inside either token; of equal rules the one further left comes first.
        """
        key = left << 20 | right
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= PAIRS:
                self.apart.clear()
            a, b, ranks = self._spine(left, True), self._spine(right, False), self.vocabulary.ranks
            i = j = 0
            known = True
            while True:
                (x, x_until), (y, y_until) = a[i], b[j]
                rank = ranks.get((x, y), NEVER)
                if rank < x_until and rank <= y_until and rank < NEVER:
                    known = False
                    break
                if x_until <= y_until:
                    if x_until == NEVER:
                        break
                    i += 1
                else:
                    j += 1
            self.apart[key] = known
        return known

    def word(self, data: bytes) -> Iterable[int]:
        """The tokens of one word, each as soon as it is stable; of one that fits the buffer all at its end."""
        return self._whole(data) if len(data) <= STRIDE else self._stream(data)

    def _whole(self, data: bytes) -> list[int]:
        """``_stream`` without emission on the way."""
        known, apart, stay_apart = self.inner_endings.get, self.apart.get, self._stay_apart
        last, begun, end = [-1], [0], len(data)
        for i in range(1, end + 1):
            if i == end:
                known = self.final_endings.get
            for a in range(i - 1, -1, -1):
                found = known(data[a:i])
                if found is None:
                    a = -1
                    break
                if found >= 0:
                    if not a:
                        break
                    left = last[a]
                    if left >= 0:
                        ok = apart(left << 20 | found)
                        if stay_apart(left, found) if ok is None else ok:
                            break
            else:
                a = -1
            last.append(found if a >= 0 else -1)
            begun.append(a)
        if not end:
            return []
        if begun[end] < 0:
            raise ValueError("the vocabulary lacks a byte")
        return self._chain(last, begun, 0, end)

    def _stream(self, data: bytes) -> Iterator[int]:
        endings, apart = self.inner_endings, self.apart
        # Position i of the buffer ends a prefix: its last token and where that began.
        last: list[int] = [-1]
        begun: list[int] = [0]
        first = 0  # what stands before is emitted
        before = -1  # the last token emitted
        end = len(data)
        stay_apart = self._stay_apart
        for i in range(1, end):
            token, a = -1, i - 1
            while a >= first:
                found = endings.get(data[a:i])
                if found is None:
                    break
                if found >= 0:
                    left = last[a - first] if a > first else before
                    if left < 0:
                        if a == first:
                            token = found
                            break
                    else:
                        ok = apart.get(left << 20 | found)
                        if stay_apart(left, found) if ok is None else ok:
                            token = found
                            break
                a -= 1
            last.append(token)
            begun.append(a)
            if (i - first) % STRIDE == 0:
                stable = self._stable(begun, first, i)
                if stable == first and i - first > self.lookahead:
                    # Further back than the lookahead nothing changes, agreed or not: the buffer has a bound.
                    stable = i
                    while i - stable < self.lookahead:
                        stable = begun[stable - first]
                if stable > first:
                    yield from self._chain(last, begun, first, stable)
                    before = last[stable - first]
                    last, begun = [-1, *last[stable - first + 1 :]], [stable, *begun[stable - first + 1 :]]
                    first = stable
        a = end - 1
        while a >= first:
            found = self.final_endings.get(data[a:end])
            if found is None:
                break
            if found >= 0:
                left = last[a - first] if a > first else before
                if (left < 0 and a == first) or (left >= 0 and stay_apart(left, found)):
                    yield from self._chain(last, begun, first, a)
                    yield found
                    return
            a -= 1
        if end:
            raise ValueError("the vocabulary lacks a byte")

    def _stable(self, begun: list[int], first: int, at: int) -> int:
        """The furthest position through which every prefix that can still be continued goes."""
        live = set(range(max(first, at - self.longest + 1), at + 1))
        while len(live) > 1:
            furthest = max(live)
            live.remove(furthest)
            live.add(begun[furthest - first])
            if first in live:
                return first
        return live.pop()

    @staticmethod
    def _chain(last: list[int], begun: list[int], first: int, end: int) -> list[int]:
        found = []
        while end > first:
            found.append(last[end - first])
            end = begun[end - first]
        return found[::-1]

    def _of_word(self, word: str) -> bytes:
        found = array("I", self.word(word.encode("utf-8", "surrogatepass"))).tobytes()
        if len(word) <= 64:
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            self.remembered[word] = found
        return found

    def text(self, text: str) -> Iterator[bytes]:
        """The ids of a text as little-endian unsigned 32-bit integers, piece by piece."""
        specials = self.vocabulary.specials
        marks = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        for piece in _pieces(text):
            for part in marks.split(piece) if marks and "<" in piece else (piece,):
                if part in specials:
                    yield int(specials[part]).to_bytes(4, "little")
                    continue
                known, fallback = self.remembered.get, self._of_word
                words = self.vocabulary.words.findall(self.vocabulary.normalized(part))
                yield b"".join([known(w) or fallback(w) for w in words])


def _pieces(text: str) -> Iterator[str]:
    """A long text cut before white space, which no word, special token or composed character contains."""
    first = 0
    while len(text) - first > PIECE:
        cut = regex.compile(r"\s").search(text, first + PIECE)
        if cut is None:
            break
        yield text[first : cut.start()]
        first = cut.start()
    yield text[first:]


class Decoder:
    """Ids to text, call by call.

    ``plain`` gives the text the bytes stand for, with a blank where a word ends; otherwise the tokens
    as they are written in the vocabulary with a blank between, as a file without a decoder is read by its library.
    """

    def __init__(self, vocabulary: Vocabulary, plain: bool = False):
        size = max(vocabulary.text_of_id) + 1
        self.table = [b""] * size
        for i, token in vocabulary.text_of_id.items():
            if not plain or i in vocabulary.specials.values():
                self.table[i] = token.encode()
            else:
                ended = bool(vocabulary.suffix) and token.endswith(vocabulary.suffix)
                self.table[i] = vocabulary.raw(token) + b" " * ended
        self.between = b"" if plain else b" "
        self.begin()

    def begin(self) -> None:
        self.state = codecs.getincrementaldecoder("utf-8")("replace")
        self.started = False

    def feed(self, ids: bytes) -> str:
        """The text that is certain after these ids."""
        if not ids:
            return ""
        joined = self.between.join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if self.started:
            joined = self.between + joined
        self.started = True
        return self.state.decode(joined)

    def end(self) -> str:
        """What an unfinished character leaves."""
        return self.state.decode(b"", final=True)


_loaded: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of a file, once per worker process."""
    if path not in _loaded:
        _loaded.clear()
        _loaded[path] = Encoder(Vocabulary(path))
    return _loaded[path]


def decoder_of(path: str, plain: bool = False) -> Decoder:
    return Decoder(encoder_of(path).vocabulary, plain)


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids``, the token ids of each whole text. Null and empty texts have none."""
    (name,) = fresh(df, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for batch in batches:
            ids = [np.frombuffer(b"".join(encoder.text(t)), "<u4").astype(np.int32) for t in text_of(batch, text).to_pylist()]
            yield appended(batch, **{name: pa.array(ids, pa.list_(pa.int32()))})
        encoder.forget()

    return over_batches(df, run, with_columns(df, **{name: "array<int>"}))


def decode(df: DataFrame, path: str, ids: str = "ids", plain: bool = True) -> DataFrame:
    """``df`` with ``decoded``, the text of each row's ids; a null list gives an empty text."""
    (name,) = fresh(df, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = decoder_of(path, plain)
        for batch in batches:
            texts = []
            for row in batch.column(batch.schema.get_field_index(ids)).to_pylist():
                decoder.begin()
                texts.append(decoder.feed(np.array(row or [], "<u4").tobytes()) + decoder.end())
            yield appended(batch, **{name: pa.array(texts, pa.string())})

    return over_batches(df, run, with_columns(df, **{name: "string"}))


def round_trip(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each whole text, encoded and decoded in one pass.

    Ids and text go through the machines piece by piece, so a long text needs no list of its tokens.
    Null and empty texts have no tokens and the digests of nothing. Repeated rows give equal digests, an empty
    table gives no rows, and taken column names make the new ones end in an underscore.
    """
    names = fresh(df, "n_tokens", "ids_sha256", "decoded_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = encoder_of(path), decoder_of(path)
        for batch in batches:
            counts, ids_digests, text_digests = [], [], []
            for whole in text_of(batch, text).to_pylist():
                ids_digest, text_digest, n = hashlib.sha256(), hashlib.sha256(), 0
                decoder.begin()
                for ids in encoder.text(whole):
                    n += len(ids) // 4
                    ids_digest.update(ids)
                    text_digest.update(decoder.feed(ids).encode())
                text_digest.update(decoder.end().encode())
                counts.append(n)
                ids_digests.append(ids_digest.hexdigest())
                text_digests.append(text_digest.hexdigest())
            columns = (pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string()))
            yield appended(batch, **dict(zip(names, columns, strict=True)))
        encoder.forget()

    return over_batches(df, run, with_columns(df, **dict(zip(names, ("long", "string", "string"), strict=True))))


def op4_bpe(documents: DataFrame, path: str) -> DataFrame:
    return round_trip(documents.select("doc_id", "text"), path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
