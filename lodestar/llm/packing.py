"""Packing documents into training sequences by non-negative least squares.

Every document is tokenized once, and gets an end token.  Its full windows are sequences of
their own; what remains (shorter than the window) is packed by length:

1. The histogram of remainder lengths has at most ``window`` bins, whatever the corpus.
2. All shallow combinations (two or three lengths that fill the window exactly) are
   columns of a non-negative least squares problem against that histogram; projected
   gradient steps with momentum solve it, with a fixed number of steps.
3. The repeat counts are rounded down, and cut where they would use more than there is.
4. Residual documents fill windows greedily, longest first; one that crosses the end of a
   window is cut there.  What is left at the very end goes into sequences at powers of two.

Documents are matched with the plan by their rank among those of equal length.  Ranks come
from counts per (length, chunk), so a length that a third of all documents have is numbered
in parallel, and only the plan (bounded by the window) is joined by range.

Cases: null text is empty (one end token); null or repeated ``doc_id`` rows are packed like
all others, row by row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import arrow_batches, stage
from lodestar.llm.exchange import give_back
from lodestar.llm.fim import groups

WINDOW = 2048
END_ID = 1
CACHE_BYTES = 24 << 20  # of remembered parts, twice (those of late, and those before)
GROUP_BYTES = 2 << 20  # of text encoded at a time
ENTRY_BYTES = 200  # what a remembered part takes beside its characters, about
STEPS = 200

# Texts of these characters only are cut here: none of them is changed by composition.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u024f]*")
# Fixed value: how the tokenizer file cuts text.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NOT_LETTERS = r"('s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+)"  # the parts to set apart from letters
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_JOINED = 2000  # parts encoded in one call


def _distinct(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """What white space leaves of all texts, by distinct items, and where each text begins and ends."""
    lists = pc.ascii_split_whitespace(texts)
    return lists.values.dictionary_encode(), np.asarray(lists.offsets)


def _gather(data: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Items (of ``size`` entries, end to end in ``data``) in the order of ``code``, and where
    each begins and ends."""
    length = size[code]
    ends = np.concatenate([[0], np.cumsum(length)])
    at = np.repeat((np.cumsum(size) - size)[code] - ends[:-1], length)
    at += np.arange(len(at))
    return data[at], ends


class WordTokenizer:
    """Token ids of whole texts, by their distinct parts.

    For a tokenizer that drops white space and treats the parts between on their own (checked
    on the file's normalizer and pre-tokenizer), a text's ids are those of its parts, which need
    no normalizing or cutting any more.  Arrow dictionary-encodes the words of a group of texts,
    and the parts of its distinct words; only distinct parts are looked up or encoded, and ids
    are gathered by number.  Words with other characters, or with the marks of special tokens, go
    to the library as they are: white space composes with no character and lies in no mark, so
    a word can be taken out of its text.  Any other tokenizer file gets whole texts.

    Parts are remembered in two generations: when the younger one takes more than
    ``CACHE_BYTES``, it becomes the older one, whose parts are forgotten unless met again.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path) as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        split = steps[0]
        added = spec.get("added_tokens", [])
        self.by_word = (split.get("behavior") == "Removed" and split.get("invert") is True
                        and (split.get("pattern") or {}).get("Regex") == _SPLIT
                        and [x["type"] for x in steps] == ["Split", "ByteLevel"]
                        and spec.get("post_processor") is None
                        and [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
                        == ["NFC", "Replace", "Lowercase"]
                        and not any(re.search(r"\s", x["content"]) or x["normalized"] or x["single_word"]
                                    for x in added))
        if self.by_word:
            # takes parts, a line each; it shares the vocabulary and has no marks of special tokens
            self.parts = Tokenizer(self.tokenizer.model)
            self.parts.normalizer = normalizers.Sequence([])
            self.parts.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split("\n", "removed"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [x["content"] for x in added]
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _encode_parts(self, parts: list[str]) -> Iterator[bytes]:
        for a in range(0, len(parts), _JOINED):
            some = parts[a:a + _JOINED]
            e = self.parts.encode("\n".join(some), add_special_tokens=False)
            ids = np.array(e.ids, self.kind).tobytes()
            of = np.array(e.word_ids, np.int64)
            ends = (np.searchsorted(of, np.arange(len(some)), side="right") * self.kind.itemsize).tolist()
            yield from (ids[x:y] for x, y in zip([0, *ends], ends))

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        found = list(map(self.young.get, parts))
        missing = [i for i, x in enumerate(found) if x is None]
        if not missing:
            return found
        new = {}
        for i in missing:
            found[i] = new[parts[i]] = self.old.get(parts[i]) if parts[i] else b""  # at a text's edge
        unknown = [i for i in missing if found[i] is None]
        for i, ids in zip(unknown, self._encode_parts([parts[i] for i in unknown])):
            found[i] = new[parts[i]] = ids
        self.young |= new
        self.size += sum(map(len, new)) + sum(map(len, new.values())) + ENTRY_BYTES * len(new)
        if self.size > CACHE_BYTES:
            self.young, self.old, self.size = {}, self.young, 0
        return found

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts of usual characters."""
        words, word_ends = _distinct(pa.array([t.lower() for t in texts], pa.large_string()))
        parts, part_ends = _distinct(pc.replace_substring_regex(words.dictionary, _NOT_LETTERS, r" \1 "))
        known = self._ids_of(parts.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // self.kind.itemsize
        ids, ends = _gather(np.frombuffer(b"".join(known), self.kind), size, np.asarray(parts.indices))
        ids, ends = _gather(ids, np.diff(ends[part_ends]), np.asarray(words.indices))
        data, places = ids.tobytes(), (ends[word_ends] * self.kind.itemsize).tolist()
        return [data[x:y] for x, y in zip(places, places[1:])]

    def _usual(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _portions(self, text: str) -> Iterator[str]:
        """A long text in portions that end before white space."""
        a = 0
        while len(text) - a > GROUP_BYTES:
            space = _SPACE.search(text, a + GROUP_BYTES)
            if not space:
                break
            yield text[a:space.start()]
            a = space.start()
        yield text[a:]

    def _pieces(self, text: str) -> Iterator[tuple[bool, str]]:
        """The text in order: stretches of usual characters, and words for the library."""
        for part in self._portions(text):
            if self._usual(part):
                yield True, part
                continue
            for usual, words in groupby(_WORDS.findall(part), self._usual):
                if usual:
                    yield True, " ".join(words)
                else:
                    yield from ((False, w) for w in words)

    def encode(self, texts: Iterable[str | None], end: Sequence[int] = ()) -> list[bytes]:
        """Ids of each text (null: none), each followed by ``end``, packed."""
        tail = np.array(end, self.kind).tobytes()
        if not self.by_word:
            return [self._library(t or "") + tail for t in texts]
        out: list[list[bytes]] = []
        usual: list[str] = []
        places: list[tuple[int, int]] = []
        size = 0

        def settle() -> None:
            for (i, j), ids in zip(places, self._encode(usual) if usual else ()):
                out[i][j] = ids
            usual.clear()
            places.clear()

        for i, text in enumerate(texts):
            out.append([])
            for plain, piece in self._pieces(text or ""):
                out[i].append(b"" if plain else self._library(piece))
                if plain:
                    usual.append(piece)
                    places.append((i, len(out[i]) - 1))
                    size += len(piece)
                    if size >= GROUP_BYTES:
                        settle()
                        size = 0
        settle()
        return [b"".join([*x, tail]) for x in out]

    def __call__(self, texts: list[str]) -> list[bytes]:
        return self.encode(texts)


@lru_cache(1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this process: a worker loads it, and learns parts, once for all its tasks."""
    return WordTokenizer(path)


def tokenize(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, chunk, row, n, ids)``: packed ids with the end token, and the place of the row.

    ``chunk`` is the task and ``row`` the row's number among the task's rows with the same
    remainder; both are meant to be written once and read from there.
    """
    def run(it):
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core

        chunk, seen = TaskContext.get().partitionId(), np.zeros(window, np.int64)
        tokenizer = word_tokenizer(path)
        for batch in it:
            for part in groups(batch, "text", GROUP_BYTES):
                ids = tokenizer.encode((t.as_py() for t in part.column("text")), [end_id])
                n = np.fromiter(map(len, ids), np.int64, len(ids)) // tokenizer.kind.itemsize
                row = []
                for r in (n % window).tolist():
                    row.append(int(seen[r]))
                    seen[r] += 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array([chunk] * len(ids), pa.int32()),
                     pa.array(row, pa.int64()), pa.array(n),
                     pa.array([tokenizer.kind.itemsize] * len(ids), pa.int32()),
                     pa.array(ids, pa.binary())],
                    ["doc_id", "chunk", "row", "n", "width", "ids"])
                del ids
                give_back()  # group by group: what they leave behind would add up

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, chunk int, row bigint, n bigint, width int, ids binary")


def combinations(window: int) -> np.ndarray:
    """All two or three lengths that fill the window, one row each, ascending; 0 pads pairs."""
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([np.zeros_like(a), a, window - a], axis=1)
    x, y = np.meshgrid(np.arange(1, window // 3 + 1), a, indexing="ij")
    z = window - x - y
    ok = (x <= y) & (y <= z)
    return np.concatenate([pairs, np.stack([x[ok], y[ok], z[ok]], axis=1)])


def solve(histogram: np.ndarray, combos: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts ``x >= 0`` that minimise ``|A x - histogram|`` over the combinations.

    Accelerated projected gradient; column sums bound the step, length 0 counts for nothing.
    """
    n = len(histogram)
    target = histogram.astype(np.float64).copy()
    target[0] = 0

    def use(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(combos[:, i], weights=x, minlength=n) for i in range(3))
        total[0] = 0
        return total

    # the columns that a length lies in, times three: no eigenvalue of A'A is larger
    step = 1.0 / (3.0 * max(1, np.bincount(combos[:, 1:].ravel(), minlength=n).max()))
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(steps):
        miss = use(y) - target
        after = np.maximum(0.0, y - step * miss[combos].sum(axis=1))
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = after + (t - 1) / grown * (after - x)
        x, t = after, grown
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first rank, end rank, first sequence, offset)`` of the combinations used.

    ``histogram[i]`` counts remainders of length i.  Whatever rank of a length lies beyond
    its last entry is residual.
    """
    combos = combinations(window)
    alive = combos[(histogram[combos] > 0).all(axis=1, where=combos > 0)]
    if not len(alive):
        return []
    repeat = np.floor(solve(histogram, alive) + 1e-9).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    out, sequence = [], 0
    for i in np.argsort(-repeat, kind="stable"):
        lengths = [int(x) for x in alive[i] if x]
        if repeat[i] <= 0:
            break
        count = min(int(repeat[i]), *(int(left[x]) // lengths.count(x) for x in lengths))
        if count <= 0:
            continue
        offset = 0
        for x in lengths:
            first = int(histogram[x] - left[x])
            out.append((x, first, first + count, sequence, offset))
            left[x] -= count
            offset += x
        sequence += count
    return out


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID,
         with_ids: bool = True) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``
    and, if asked for, ``ids``, its tokens as an array."""
    spark = docs.sparkSession
    with arrow_batches(spark, GROUP_BYTES):
        tokens = stage(tokenize(docs, path, window, end_id), "packing-tokens")
    rest = tokens.select("doc_id", "chunk", "row", "n", (F.col("n") % window).alias("rest"))
    per_chunk = stage(rest.groupBy("rest", "chunk").agg(
        F.count("*").alias("rows"), F.sum(F.expr(f"n div {window}")).alias("full")), "packing-counts")
    before = lambda c, by: F.sum(c).over(Window.partitionBy(by).orderBy("chunk")) - F.col(c)
    chunks = per_chunk.withColumn("before", before("rows", "rest"))

    histogram = np.zeros(window, np.int64)
    windows = np.zeros(window, np.int64)
    for r in per_chunk.groupBy("rest").agg(F.sum("rows"), F.sum("full")).toLocalIterator():
        histogram[r[0]], windows[r[0]] = r[1], r[2]  # one row a length
    histogram[0] = 0
    entries = plan(histogram, window)
    packed = max((s + e - f for _, f, e, s, _ in entries), default=0)
    used = np.zeros(window, np.int64)
    for x, _, end, _, _ in entries:
        used[x] = max(used[x], end)
    # residual documents lie end to end, longest first
    residual = (histogram - used) * np.arange(window)
    base = np.concatenate([np.cumsum(residual[::-1])[::-1][1:], [0]])
    total = int(residual.sum())
    full_windows, tail = divmod(total, window)

    slots = spark.createDataFrame(entries, "rest bigint, first bigint, end bigint, sequence bigint, at bigint")
    lengths = spark.createDataFrame(
        [(i, int(used[i]), int(base[i])) for i in range(1, window)], "rest bigint, used bigint, base bigint")
    ranked = rest.join(chunks.select("rest", "chunk", "before"), ["rest", "chunk"]).withColumn(
        "rank", F.col("before") + F.col("row"))
    of = ["doc_id", "chunk", "row", "rest"]
    # both tables are bounded by the window, not by the data
    planned = ranked.join(F.broadcast(slots), "rest").where("rank >= first and rank < end").select(
        *of, F.col("n").alias("doc_tokens"), (F.col("n") - F.col("rest")).alias("start"),
        F.col("rest").alias("length"), (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        F.col("at").alias("offset"))
    # a residual document covers [from, to) of the line of residuals, cut at window ends and,
    # in the last window, after every power of two in the tail
    cuts = [0]
    for bit in range(window.bit_length() - 1, -1, -1):
        if tail >> bit & 1:
            cuts.append(cuts[-1] + (1 << bit))
    ends = F.array(*[F.lit(full_windows * window + c).cast("bigint") for c in cuts])
    line = ranked.join(F.broadcast(lengths), "rest").where("rank >= used").withColumn(
        "from", F.col("base") + (F.col("rank") - F.col("used")) * F.col("rest")).withColumn(
        "to", F.col("from") + F.col("rest"))
    inner = F.filter(F.array_union(F.array((F.expr(f"`from` div {window}") + 1) * window), ends),
                     lambda c: (c > F.col("from")) & (c < F.col("to")) & (c <= F.lit(full_windows * window + tail)))
    points = F.array_sort(F.array_distinct(F.concat(F.array("from", "to"), inner)))
    pieces = line.withColumn("points", points).select(
        *of, "n", "from", F.posexplode(F.expr("slice(points, 1, size(points) - 1)")).alias("i", "lo"), "points")
    in_tail = F.col("lo") >= full_windows * window
    part = F.size(F.filter(ends, lambda c: c <= F.col("lo")))  # of the tail, from 1
    residuals = pieces.select(
        *of, F.col("n").alias("doc_tokens"),
        (F.col("n") - F.col("rest") + F.col("lo") - F.col("from")).alias("start"),
        (F.expr("points[i + 1]") - F.col("lo")).alias("length"),
        (F.lit(packed) + F.when(in_tail, F.lit(full_windows) + part - 1)
         .otherwise(F.expr(f"lo div {window}"))).cast("bigint").alias("sequence_id"),
        F.when(in_tail, F.col("lo") - F.element_at(ends, part)).otherwise(F.col("lo") % window).alias("offset"))

    # full windows are numbered behind those, document by document
    first_full = packed + full_windows + len(cuts)
    offsets = per_chunk.groupBy("chunk").agg(F.sum("full").alias("all")).select(  # a row a task
        "chunk", (F.sum("all").over(Window.orderBy("chunk")) - F.col("all")).alias("earlier"))
    long = rest.withColumn("full", F.expr(f"n div {window}")).where("full > 0")
    own = F.sum("full").over(Window.partitionBy("chunk").orderBy("rest", "row")) - F.col("full")
    whole = long.withColumn("own", own).join(F.broadcast(offsets), "chunk").withColumn(
        "before", F.col("earlier") + F.col("own"))
    wholes = whole.select(*of, "n", "before", F.posexplode(F.sequence(F.lit(1), F.col("full"))).alias("i", "_")).select(
        *of, F.col("n").alias("doc_tokens"), (F.col("i") * F.lit(window)).cast("bigint").alias("start"),
        F.lit(window).cast("bigint").alias("length"),
        (F.lit(first_full) + F.col("before") + F.col("i")).cast("bigint").alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"))

    piece = F.struct("start", "length", "sequence_id", "offset")
    lists = planned.unionByName(residuals).unionByName(wholes).groupBy("chunk", "rest", "row").agg(
        F.collect_list(piece).alias("pieces"))  # of one document, so it is no longer than that
    joined = tokens.withColumn("rest", F.col("n") % window).join(lists, ["chunk", "rest", "row"])
    source = joined.select("doc_id", F.col("n").alias("doc_tokens"), "width", "ids", "pieces")
    schema = ", ".join(f"{c} bigint" for c in _PIECE) + ", ids array<int>" * with_ids

    def cut(it):
        for batch in it:
            for a in range(0, batch.num_rows, 256):
                yield _pieces(batch.slice(a, 256).to_pylist(), with_ids)

    return source.mapInArrow(cut, schema)


_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _pieces(rows: list[dict], with_ids: bool) -> pa.RecordBatch:
    out, tokens = [], []
    for r in rows:
        ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
        for p in sorted(r["pieces"], key=lambda p: p["start"]):
            part = ids[p["start"]:p["start"] + p["length"]]
            out.append((r["doc_id"], p["start"], p["length"], zlib.crc32(part.tobytes()),
                        r["doc_tokens"], p["sequence_id"], p["offset"]))
            if with_ids:
                tokens.append(part.astype(np.int32))
    arrays = [pa.array(c, pa.int64()) for c in zip(*out)]
    if with_ids:
        return pa.RecordBatch.from_arrays([*arrays, pa.array(tokens, pa.list_(pa.int32()))], [*_PIECE, "ids"])
    return pa.RecordBatch.from_arrays(arrays, _PIECE)
