"""Personal data: fixed patterns, and a character-level BiLSTM-CRF that adds what they miss.

Four patterns with checks give the base spans, which always stand. The tagger is trained on a bounded
sample of windows of each kind and of none, labelled by the base spans, and on variants of
them that the patterns do not match (no plus sign, a spelt-out at sign). Texts are read through
overlapping windows, all of them; every character has its scores from the window it lies deepest in, and one path is decoded
for the whole text, so that no decision depends on how a batch was cut. A stretch that the best path marks must gain more by its
scores than its transitions cost. Where no stretch can, which is seen from sums over the text, the path stays
outside; only the path between such characters is searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import zip_longest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.batches import appended, fresh, over_batches, text_of, with_columns
from millrace.llm.tagger import Tagger, bio_transitions
from millrace.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
#: Characters of the parts that the tagger is trained on, and between the beginnings of two.
PART, STEP = 96, 48
#: Characters that a window decides on, and that it reads before and behind them besides.
STRIDE, MARGIN = 192, 32
WIDTH = STRIDE + 2 * MARGIN
#: Windows the tagger is trained on at most, and how.
SAMPLE, ROUNDS, BATCH, RATE, HIDDEN, SEED = 1200, 20, 64, 0.03, 12, 11
#: Windows scored at once, and positions decoded at once.
SCORED, DECODED = 1024, 1 << 17

#: How far a mark lies below outside where a path is known to be outside.
NEVER_MARKED = 100

# The base patterns. Possessive repeats and anchors find what the plain patterns
# find, in time proportional to the text.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
CARD_DIGITS = 14, 19
#: An address in any notation: words, an at sign or word, and two labels or more, with dots or the word.
ADDRESS = re.compile(r"[\w%+-]++(?:(?:\.|\s+dot\s+)[\w%+-]++)*\s*(?:@|[(\[]at[)\]]|\bat\b)\s*[\w-]++(?:(?:\.|\s+dot\s+)[\w-]++)+")
#: What is not taken for free of personal data because the base patterns match nothing in it.
DOUBTFUL = re.compile(ADDRESS.pattern + r"|(?:[0-9][^\w\n]{0,2}){9}[0-9]|[0-9]+(?:[^\w\n]{1,3}[0-9]+){3}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)


def _is_phone(text: str) -> bool:
    return 10 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        name = LOCAL.match(text[free:at][::-1])
        domain = name and DOMAIN.match(text, at + 1)
        if domain:
            yield at - name.end(), domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans (start, end, kind) that match and pass, by start and kind; and those whose match failed its check.

    Numbers with fewer digits than a card are no failed cards: the card pattern matches every number.
    """
    found, failed = [], []
    if not TRIGGER.search(text):
        return found, failed
    found += [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    for kind, pattern, passes in ((1, IP, _is_ip), (2, CARD, _is_card), (3, PHONE, _is_phone)):
        if kind == 3 and "+" not in text:
            continue
        for m in pattern.finditer(text):
            if passes(m[0]):
                found.append((m.start(), m.end(), kind))
            elif kind != 2 or len(_digits(m[0])) >= CARD_DIGITS[0]:
                failed.append((*m.span(), kind))
    return sorted(found, key=lambda s: (s[0], s[2])), failed


def _table() -> np.ndarray:
    """The symbol of every ASCII character: classes for letters and digits, one each for the marks the kinds use."""
    table = np.full(128, 1, np.uint8)
    for chars, symbol in (("0123456789", 2), ("abcdefghijklmnopqrstuvwxyz", 3), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 4)):
        table[[ord(c) for c in chars]] = symbol
    for i, c in enumerate("@.+-() _%\n\t,:;=\"/|'"):
        table[ord(c)] = 6 + i
    # Letters of the spelt-out marks.
    for i, c in enumerate("atdoATDO"):
        table[ord(c)] = 25 + i % 4
    return table


ASCII, SYMBOLS, PADDING, FOREIGN = _table(), 29, 0, 5


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, ASCII[np.minimum(points, 127)], np.uint8(FOREIGN))


def windows_of(codes: np.ndarray) -> np.ndarray:
    """All windows of a text (n, WIDTH), padded at its end; window k covers WIDTH characters from k STRIDE."""
    n = max(1, -(-(len(codes) - MARGIN) // STRIDE))
    padded = np.full(n * STRIDE + 2 * MARGIN, PADDING, np.uint8)
    padded[: len(codes)] = codes
    return np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[::STRIDE]


def _part(codes: np.ndarray) -> np.ndarray:
    out = np.full(PART, PADDING, np.uint8)
    out[: len(codes)] = codes[:PART]
    return out


def _tags(spans: list[tuple[int, int, int]], start: int, length: int) -> np.ndarray:
    """Tags of the characters from ``start`` on; of overlapping spans the first stands."""
    tags = np.zeros(length, np.int64)
    for a, b, kind in spans:
        low, high = max(a - start, 0), min(b - start, length)
        if low < high and not tags[low:high].any():
            tags[low:high] = 2 * kind + 2
            if a >= start:
                tags[low] = 2 * kind + 1
    return tags


def _grouped(digits: str, least: int, mark: str, rng: np.random.Generator) -> str:
    """Digits in groups of four, or of ``least`` to four."""
    out = []
    while digits:
        size = int(rng.integers(least, 5))
        out.append(digits[:size])
        digits = digits[size:]
    return mark.join(out)


def _other_address(rng: np.random.Generator) -> str:
    """An address of other words, so that the tagger learns the form and not the words."""

    def word(low: int, high: int) -> str:
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(low, high))))

    name = word(2, 10) + str(rng.choice(["", "", ".", "_", "-"])) + str(rng.choice(["", word(2, 8), str(rng.integers(1, 1000))]))
    hosts = [word(3, 10) + str(rng.choice(["", "", str(rng.integers(1, 10))])) for _ in range(int(rng.integers(1, 3)))]
    return ".".join([f"{name.strip('._-')}@{hosts[0]}", *hosts[1:], str(rng.choice(["com", "org", "net", word(2, 4)]))])


def _variants(text: str, spans: list[tuple[int, int, int]], rng: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its spans written as the patterns do not match them."""
    out, moved, done = [], [], 0
    size = 0
    for a, b, kind in spans:
        if a < done:
            continue
        out.append(text[done:a])
        size += a - done
        value = text[a:b]
        if kind == 0:
            if rng.random() < 0.5:
                value = _other_address(rng)
            value = value.replace("@", str(rng.choice([" at ", "(at)", " (at) ", " @ "])))
            if rng.random() < 0.5:
                value = value.replace(".", " dot ")
        elif kind == 3:
            value = value.removeprefix("+")
            if rng.random() < 0.5:
                value = _grouped(_digits(value), 3, str(rng.choice([" ", "-", "/"])), rng)
            elif rng.random() < 0.5:
                value = value.replace(" ", "/")
        elif kind == 2:
            value = _grouped(_digits(value), 4, str(rng.choice([".", "/", "_", "  "])), rng)
        else:
            value = value.replace(".", str(rng.choice([" . ", ",", "[.]"])))
        out.append(value)
        moved.append((size, size + len(value), kind))
        size += len(value)
        done = b
    out.append(text[done:])
    return "".join(out), moved


def _sampled(sample: int):
    """Of each class the ``sample`` windows of least hash in a partition (of those without a span an eighth), (class, order, part, spans).

    The class is a kind the window holds a span of, or beyond them whether it has a digit or an at sign at all. Windows are
    labelled by the spans of the whole text, so that one cut by a window's border is labelled too. What may be personal data in
    another notation, there or just beside, is no example of what is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: list[dict] = [{} for _ in range(len(KINDS) + 2)]
        rooms = [sample if k < len(KINDS) else sample // 8 for k in range(len(least))]
        # The largest order that can still be among the least.
        limits = [1 << 63] * len(least)

        def narrowed(k: int) -> None:
            least[k] = dict(sorted(least[k].items())[: rooms[k]])
            if len(least[k]) == rooms[k]:
                limits[k] = max(least[k], default=(0,))[0]

        for batch in batches:
            for text in text_of(batch).to_pylist():
                spans = base_spans(text)[0]
                for at in range(0, len(text), STEP):
                    part = text[at : at + PART]
                    own = [(a - at, b - at, k) for a, b, k in spans if a < at + PART and b > at] if spans else []
                    order = xxhash.xxh64_intdigest(part.encode("utf-8", "surrogatepass"), SEED) >> 1
                    for k in {k for _, _, k in own} or {len(KINDS) + (TRIGGER.search(part) is None)}:
                        if order > limits[k] or not own and DOUBTFUL.search(text, max(0, at - STEP), at + PART + STEP):
                            continue
                        least[k][(order, part, str(own))] = own
                        if len(least[k]) > 2 * rooms[k]:
                            narrowed(k)
        rows = []
        for k in range(len(least)):
            narrowed(k)
            rows += [(k, order, part, [list(x) for x in own]) for (order, part, _), own in least[k].items()]
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int32())))
        if rows:
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["class", "o", "part", "spans"])

    return run


def fit(df: DataFrame, text: str = "text", sample: int = SAMPLE) -> Tagger | None:
    """A tagger trained on at most ``sample`` different windows of the texts, in hash order; None without any base span.

    Each kind has an equal share of three quarters of the sample, which others take up where it has fewer
    windows; a quarter is kept for windows without a base span, half of it for those with a digit or an at sign.
    """
    parts = cut_lineage(over_batches(df.select(F.col(text).alias("text")), _sampled(sample), "class int, o long, part string, spans array<array<int>>"))
    parts = parts.distinct()
    wanted = sample - sample // 4
    some, spare, none = {}, [], []
    for k in range(len(KINDS) + 2):
        rows = parts.filter(F.col("class") == k).orderBy("o", "part", "spans").limit(sample).collect()
        cases = [(r.part, [tuple(x) for x in r.spans]) for r in rows]
        if k < len(KINDS):
            share = wanted // len(KINDS)
            some.update({(t, str(x)): (t, x) for t, x in cases[:share]})
            spare.append(cases[share:])
        else:
            none += cases[: sample // 8]
    for cases in zip_longest(*spare):
        for t, x in filter(None, cases):
            if len(some) < wanted:
                some.setdefault((t, str(x)), (t, x))
    some = list(some.values())
    if not some:
        return None
    rng = np.random.default_rng(SEED)
    whole = [(t, x) for t, x in some if all(0 <= a and b <= len(t) for a, b, _ in x)]
    cases = some + none + [_variants(*x, rng) for x in whole]
    codes = np.stack([_part(codes_of(t)) for t, _ in cases])
    tags = np.stack([_tags(spans, 0, PART) for _, spans in cases])
    tagger = Tagger(SYMBOLS, 2 * len(KINDS) + 1, HIDDEN, bio_transitions(len(KINDS)), SEED)
    return tagger.train(codes, tags, ROUNDS, BATCH, RATE, SEED).narrowed()


def _gains(tagger: Tagger) -> tuple[float, float]:
    """What a marked stretch gains by transitions over staying outside, at most: once, and for each character behind its first."""
    trans = np.where(tagger.mask < 0, -np.inf, tagger.p["trans"].astype(np.float64))
    start = tagger.p["start"].astype(np.float64)
    begin, inside = np.arange(1, len(start), 2), np.arange(2, len(start), 2)
    # Entered from any tag or at the start of the text, left for outside, another beginning, or at its end.
    entered = max((trans[:, begin] - trans[:, :1]).max(), (start[1:] - start[0]).max())
    left = max(0.0, (trans[1:, [0, *begin]] - trans[0, [0, *begin]]).max())
    going_on = max(trans[begin, inside].max(), trans[inside, inside].max()) - trans[0, 0]
    return float(entered + left), float(going_on)


def _free(margins: np.ndarray, once: float, each: float) -> np.ndarray:
    """Which characters a best path may mark, from the margins of their best tag over outside.

    The gain of a stretch is the sum of its margins and transitions at most. A character is free if the best of all
    stretches around it gains something; the best one ends at the highest sum to come and begins behind the lowest before.
    """
    sums = np.cumsum(margins, dtype=np.float64)
    sums += each * np.arange(1, len(sums) + 1)
    best = np.maximum.accumulate(sums[::-1])[::-1].copy()
    sums[1:] = sums[:-1].copy()
    sums[:1] = 0
    best -= np.minimum(np.minimum.accumulate(sums), 0)
    return best >= each - once - 1e-3


class Scores:
    """Scores of neighbouring windows: (rows, tags, windows), the rows of a window being its first STRIDE + MARGIN characters.

    Only the windows in ``first``, which begin a text, decide on their first MARGIN characters; the others are not scored there.
    """

    def __init__(self, tagger: Tagger, windows: np.ndarray, first: list[int]):
        self.each = tagger.scores(windows.T, STRIDE + MARGIN, MARGIN, np.array(first, np.intp))

    def margins(self) -> np.ndarray:
        """The margin of the best tag over outside, (windows, rows)."""
        return np.ascontiguousarray((self.each[:, 1:].max(axis=1) - self.each[:, 0]).T)

    def of(self, first: int, low: int, high: int) -> np.ndarray:
        """(characters, tags) from ``low`` to ``high`` of a text whose first window is ``first``."""
        at = np.arange(low, high)
        k = np.maximum((at - MARGIN) // STRIDE, 0)
        return self.each[at - k * STRIDE, :, first + k]


def _whole(margins: np.ndarray, length: int) -> np.ndarray:
    """Margins of a text from those of its windows: each character's from the window that decides on it."""
    return np.concatenate([margins[0, :MARGIN], margins[:, MARGIN:].reshape(-1)])[:length]


def _tagged(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """What the tagger marks in each text."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    once, each = _gains(tagger)
    pieces: list[tuple[int, int, np.ndarray]] = []
    group, held, open_size, counted = [], 0, 0, 0
    for i, text in enumerate(texts):
        if not text:
            continue
        codes = codes_of(text)
        windows = windows_of(codes)
        if group and held + len(windows) > SCORED:
            pieces += _scored(tagger, group, once, each)
            group, held = [], 0
        if len(windows) > SCORED:
            pieces += _scored_long(tagger, i, windows, len(codes), once, each)
        else:
            group.append((i, len(codes), windows))
            held += len(windows)
        open_size += sum(len(p[2]) for p in pieces[counted:])
        counted = len(pieces)
        if open_size >= DECODED:
            _decode(tagger, pieces, found)
            pieces, open_size, counted = [], 0, 0
    if group:
        pieces += _scored(tagger, group, once, each)
    _decode(tagger, pieces, found)
    return found


def _scored(tagger: Tagger, group, once: float, each: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """The open pieces of some texts."""
    begins = np.cumsum([0, *(len(w) for _, _, w in group[:-1])]).tolist()
    scores = Scores(tagger, np.concatenate([w for _, _, w in group]), begins)
    margins = scores.margins()
    at = 0
    for i, length, windows in group:
        free = _free(_whole(margins[at : at + len(windows)], length), once, each)
        yield from _pieces(i, free, lambda low, high, first=at: scores.of(first, low, high))
        at += len(windows)


def _scored_long(tagger: Tagger, i: int, windows: np.ndarray, length: int, once: float, each: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """The open pieces of a text too long for its scores to be held: its margins are, and open parts are scored again."""
    margins = np.concatenate([Scores(tagger, windows[k : k + SCORED], [0]).margins() for k in range(0, len(windows), SCORED)])
    free = _free(_whole(margins, length), once, each)
    del margins

    def scores(low: int, high: int) -> np.ndarray:
        out = []
        while low < high:
            first = max((low - MARGIN) // STRIDE, 0)
            to = min(high, (first + SCORED) * STRIDE + MARGIN)
            own = Scores(tagger, windows[first : first + SCORED][: -(-(to - first * STRIDE) // STRIDE)], [0])
            # Positions count from the first window read; past its margin they are decided alike.
            out.append(own.of(0, low - first * STRIDE, to - first * STRIDE))
            low = to
        return np.concatenate(out)

    yield from _pieces(i, free, scores)


def _pieces(i: int, free: np.ndarray, scores) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, first, scores) of the parts whose path is open, each with the outside characters at its ends."""
    marks = np.concatenate([[False], free, [False]])
    edges = np.flatnonzero(marks[1:] != marks[:-1])
    for a, b in edges.reshape(-1, 2).tolist():
        low, high = max(a - 1, 0), min(b + 1, len(free))
        part = scores(low, high)
        for k, edge in ((0, low < a), (-1, high > b)):
            if edge:
                part[k] = -NEVER_MARKED
                part[k, 0] = 0
        yield i, low, part


def _decode(tagger: Tagger, pieces, found) -> None:
    order = sorted(pieces, key=lambda p: len(p[2]))
    group: list = []
    for piece in [*order, None]:
        if group and (piece is None or len(piece[2]) * (len(group) + 1) > DECODED or len(piece[2]) > 2 * len(group[0][2])):
            longest = max(len(p[2]) for p in group)
            padded = np.full((len(group), longest, group[0][2].shape[1]), -NEVER_MARKED, np.float32)
            padded[:, :, 0] = 0
            for row, (_, _, part) in enumerate(group):
                padded[row, : len(part)] = part
            for (i, low, part), path in zip(group, tagger.best_path(padded), strict=True):
                found[i] += _spans(path[: len(part)], low)
            group = []
        if piece is not None:
            group.append(piece)
    for spans in found:
        spans.sort()


def _spans(path: np.ndarray, start: int) -> Iterator[tuple[int, int, int]]:
    inside = path > 0
    if not inside.any():
        return
    kind = (path.astype(np.int64) - 1) // 2
    begins = inside & ((path % 2 == 1) | np.concatenate([[True], ~inside[:-1]]))
    ends = inside & np.concatenate([begins[1:] | ~inside[1:], [True]])
    for a, b in zip(np.flatnonzero(begins), np.flatnonzero(ends), strict=True):
        yield start + int(a), start + int(b) + 1, int(kind[a])


def _confirmed(text: str, a: int, b: int, kind: int) -> tuple[int, int] | None:
    """What stands the checks of its kind in a marked span grown to whole words or numbers: notation is free, the value is not.

    Of an address that is the part written as one, of the others the whole.
    """
    a, b = _whole_words(text, a, b, kind)
    value = text[a:b]
    if kind == 0:
        m = ADDRESS.search(value)
        return (a + m.start(), a + m.end()) if m else None
    if kind == 1:
        parts = re.findall(r"[0-9]+", value)
        fine = len(parts) == 4 and _is_ip(".".join(parts))
    else:
        fine = _is_card(value) if kind == 2 else _is_phone(value)
    return (a, b) if fine else None


def _whole_words(text: str, a: int, b: int, kind: int) -> tuple[int, int]:
    """The span grown to whole numbers, or for an address to whole words."""
    part = str.isalnum if kind == 0 else str.isdigit
    while a > 0 and part(text[a]) and part(text[a - 1]):
        a -= 1
    while b < len(text) and part(text[b - 1]) and part(text[b]):
        b += 1
    return a, b


def find(texts: list[str], tagger: Tagger | None) -> list[tuple[list, list]]:
    """For each text its base spans, and all spans: base ones and what the tagger adds beside them.

    An addition passes the checks of its kind (``_confirmed``), touches no base span and no other addition, and holds no
    match of its own kind that failed its check.
    """
    out = []
    marked = _tagged(tagger, texts) if tagger is not None else [[] for _ in texts]
    for text, more in zip(texts, marked, strict=True):
        base, failed = base_spans(text)
        taken = [(a, b) for a, b, _ in base]
        added = []
        for a, b, kind in more:
            own = _confirmed(text, a, b, kind)
            against = taken + [(x, y) for x, y, k in failed if k == kind]
            if own and not any(own[0] < y and x < own[1] for x, y in against):
                added.append((*own, kind))
                taken.append(own)
        out.append((base, sorted(base + added, key=lambda s: (s[0], s[2]))))
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans are one, of the first one's kind."""
    out, done = [], 0
    merged: list[list[int]] = []
    for a, b, kind in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, kind])
    for a, b, kind in merged:
        out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = b
    return "".join([*out, text[done:]])


def find_pii(df: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``spans``, arrays of (kind, start, end) in code points, for each whole text.

    Null and empty texts have none; a very long text is read in blocks of windows. Repeated rows get equal spans, an empty table gives no rows,
    taken column names make the new ones end in an underscore. Without a tagger all spans are base spans.
    """
    base_name, spans_name = fresh(df, "base", "spans")
    kind = "array<struct<kind:string,start:long,end:long>>"
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    shared = df.sparkSession.sparkContext.broadcast(tagger)  # a few thousand weights

    def listed(spans):
        return [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = find(text_of(batch, text).to_pylist(), shared.value)
            columns = {n: pa.array([listed(f[i]) for f in found], arrow) for i, n in enumerate((base_name, spans_name))}
            yield appended(batch, **columns)

    return over_batches(df, run, with_columns(df, **{base_name: kind, spans_name: kind}))


def redact(df: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """``df`` with every span in ``text`` replaced by its kind in brackets; null texts stay null, empty ones empty.

    Whole texts are read, a very long one in blocks of windows. Of overlapping spans one mark of the first one's kind is left.
    Repeated rows get equal texts, an empty table gives no rows, and other columns, whatever their names, stay as they are.
    """
    shared = df.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column = batch.column(at)
            texts = text_of(batch, text).to_pylist()
            clean = [redacted(t, s) for t, (_, s) in zip(texts, find(texts, shared.value), strict=True)]
            values = [c if v else None for c, v in zip(clean, column.is_valid().to_pylist(), strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(values, column.type))

    return over_batches(df, run, df.schema)


def op8_pii(documents: DataFrame) -> DataFrame:
    """Counts and digests of the operator's spans."""
    rows = documents.select("doc_id", "text")
    found = find_pii(rows, fit(rows)).select("doc_id", "base", "spans")

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def counted(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
