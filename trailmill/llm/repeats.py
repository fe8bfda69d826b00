"""Repeated byte strings across documents, from the common-prefix interval trees of suffixes at shared anchors.

A string of ``length`` bytes that starts at two places holds the same anchors at both: of each window of
``length`` bytes the ``gram``-byte strings with the smallest hash. Only anchors whose hash occurs twice are looked at.
Around each stands its context, the bytes that a repeated string through it can reach.

The contexts of one anchor string form an enhanced suffix array: sorted by what follows, with the common prefix lengths
of neighbours. A scan with a stack lists the intervals of its common-prefix tree: all occurrences, not only neighbours,
that agree in r bytes from the anchor on. Inside an interval the occurrences are ordered by what stands before them, and a
second scan finds those that agree in the l bytes before the anchor. Where l + r reaches ``length``, extensions on both
sides differ (or text or context ends) and the occurrences make up one maximal repeat group, ``repeat_groups``. The bytes to
remove at an occurrence reach from its longest l to its longest r, since all its repeats hold the anchor.

Contexts that occur whole more than once are one group at once and go on as one row with their number, so groups of
near copies shrink to their distinct contexts before any are gathered.

Anchors with more distinct contexts than ``GROUP`` are not gathered: the range of reaches to the left is halved, and each half keyed by
the longer string that all its members must share. Contexts that agree in every byte such a half can touch repeat there in all their
strings and go on as one; those that then stand alone drop out. Halving goes on until groups are small, at the
latest when a half is one reach and its key the whole repeated string.

Rows meet the numbers of their anchor in a shuffle, but for keys with more than 1 / ``HOT`` of all rows, fewer than ``HOT``,
whose numbers are sent. Texts always move in a shuffle, by text and row, at every size of the input.

Defined cases: a null text is empty; texts below ``length`` bytes are never cut; texts of any length are read whole; equal texts are
read once and count by their number; null ids and repeated rows are rows like any other; an empty table gives an empty
result; ties in the order of suffixes do not matter, as equal sides fall into one interval; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.llm.storage import stored
from trailmill.llm.tables import mapped
from trailmill.scale import hinted

LENGTH = 400
GRAM = 100
#: Most contexts of one anchor in a task: 7 MB of bytes, no more than a task holds of small groups.
GROUP = 10_000
BATCH = 20_000
#: Keys with more than this part of all rows are joined without a shuffle.
HOT = 1000
#: Most rows with keys that are sent to all tasks: 56 bytes each.
SENT_ROWS = 300_000
BYTE_CODES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
STEP = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** i and its inverse modulo 2 ** 64 for i below ``size``."""
    if len(_powers.get("up", ())) < size:
        size = max(size, 1 << 17)
        for name, base in (("up", STEP), ("down", pow(STEP, -1, 1 << 64))):
            row = np.full(size, np.uint64(base))
            row[0] = 1
            _powers[name] = np.multiply.accumulate(row)
    return _powers["up"], _powers["down"]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every string of ``gram`` bytes, from running sums of weighted byte codes."""
    up, down = powers(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_CODES[data] * down[: len(data)], dtype=np.uint64)])
    count = len(data) - gram + 1
    x = (sums[gram:] - sums[:count]) * up[:count]
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def sliding(x: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """``best`` of every window of ``width`` values, from running bests of blocks in both directions."""
    padded = np.full(-(-len(x) // width) * width, np.uint64(fill))
    padded[: len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(x) - width + 1
    return best(back[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the strings with the smallest hash of some window of ``length`` bytes."""
    if len(data) < length:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    width = length - gram + 1
    least = sliding(hashes, width, np.minimum, (1 << 64) - 1)
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(sliding(around, width, np.maximum, 0) == hashes)
    return at.astype(np.int32), hashes[at].view(np.int64)


def list_array(rows: list[np.ndarray], kind: type) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(rows) if rows else np.zeros(0, kind))


def anchor_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """tid, row, places and hashes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(x, length, gram) for x in batch.column("data").to_pylist()]
            arrays = [list_array([f[0] for f in found], np.int32), list_array([f[1] for f in found], np.int64)]
            yield pa.RecordBatch.from_arrays([batch.column("tid"), batch.column("row"), *arrays], ["tid", "row", "places", "hashes"])

    return rows.select("tid", "row", "data").mapInArrow(run, "tid binary, row string, places array<int>, hashes array<long>")


def context_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per shared anchor: key, n, tid, place, copies, left, right and the context bytes."""
    reach = length - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("key", "n", "tid", "place", "copies", "left", "right", "context")}
            columns = (batch.column(c).to_pylist() for c in ("tid", "data", "places", "keys", "counts", "weights"))
            for tid, data, places, keys, counts, weights in zip(*columns, strict=True):
                for place, key, n, copies in zip(places, keys, counts, weights, strict=True):
                    left, right = min(place, reach), min(len(data) - place, length)
                    out["key"].append(key)
                    out["n"].append(n)
                    out["tid"].append(tid)
                    out["place"].append(place)
                    out["copies"].append(copies)
                    out["left"].append(left)
                    out["right"].append(right)
                    out["context"].append(bytes(reach - left) + data[place - left : place + right] + bytes(length - right))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    schema = "key long, n long, tid binary, place int, copies long, left int, right int, context binary"
    return rows.select("tid", "data", "places", "keys", "counts", "weights").mapInArrow(run, schema)


def enhanced(sides: np.ndarray, lengths: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the padded ``sides`` inside each group, and the common prefix length with the row before (-1 between groups).

    A side that ends comes before those that go on, so a common prefix is the least one between two rows.
    """
    order = np.lexsort((lengths, sides.view(f"S{sides.shape[1]}").ravel(), group))
    ordered, own, ends = sides[order], group[order], lengths[order]
    differ = ordered[1:] != ordered[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), sides.shape[1])
    common = np.minimum(common, np.minimum(ends[1:], ends[:-1]))
    common[own[1:] != own[:-1]] = -1
    return order, np.concatenate([[-1], common])


def intervals(common: list[int], floor: int) -> Iterator[tuple[int, int, int]]:
    """Begin, end and common prefix of every interval of two or more rows that share at least ``floor`` bytes, inner ones first."""
    stack: list[tuple[int, int]] = []
    for i in range(1, len(common) + 1):
        here = common[i] if i < len(common) else -1
        begin = i - 1
        while stack and stack[-1][0] > here:
            depth, begin = stack.pop()
            yield begin, i, depth
        if here >= floor and (not stack or stack[-1][0] < here):
            stack.append((here, begin))


class Tree:
    """The interval tree of the contexts of some anchors, with the order of their left sides.

    The left side of a row may count up to ``left`` bytes and the right side up to ``right``.
    """

    def __init__(self, group, left, right, contexts, length: int, gram: int):
        reach, count = length - gram, len(group)
        table = np.frombuffer(b"".join(contexts), np.uint8).reshape(count, reach + length)
        self.length, self.floor = length, gram
        after = np.ascontiguousarray(table[:, reach:])
        before = np.ascontiguousarray(table[:, :reach][:, ::-1])
        self.order, self.common = enhanced(after, right, group)
        order, common = enhanced(before, left, group)
        self.rank = np.empty(count, np.int64)
        self.rank[order] = np.arange(count)
        self.least = [common]
        while len(self.least[-1]) > 1 << len(self.least) - 1:
            row, step = self.least[-1], 1 << len(self.least) - 1
            self.least.append(np.minimum(row[:-step], row[step:]))

    def shared_left(self, ranks: np.ndarray) -> np.ndarray:
        """Common left extension of neighbours in ascending ``ranks``: the least one between them."""
        out = np.empty(len(ranks) - 1, np.int64)
        first, last = ranks[:-1] + 1, ranks[1:]
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        for k in set(level.tolist()):
            at = level == k
            out[at] = np.minimum(self.least[k][first[at]], self.least[k][last[at] + 1 - (1 << k)])
        return out

    def nodes(self) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """Begin, end, right extension, members by left side, left extensions of neighbours, of every interval."""
        for begin, end, depth in intervals(self.common.tolist(), self.floor):
            members = self.order[begin:end]
            members = members[np.argsort(self.rank[members])]
            yield begin, end, depth, members, self.shared_left(self.rank[members])

    def groups(self) -> Iterator[tuple[np.ndarray, int, int]]:
        """Members, left and right extension of every maximal repeat group.

        A group inside one child of its interval goes on to the right and is listed there.
        """
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        for begin, end, depth, members, shared in self.nodes():
            child = np.cumsum(np.concatenate([[0], self.common[begin + 1 : end] == depth]))[place[members] - begin]
            for first, last, left in intervals([-1, *shared.tolist()], self.length - depth):
                if (child[first:last] != child[first]).any():
                    yield members[first:last], left, depth

    def reaches(self) -> tuple[np.ndarray, np.ndarray]:
        """Per row the longest left and right extension of its repeats, -1 where it has none."""
        longest_left, longest_right = (np.full(len(self.order), -1) for _ in range(2))
        for _, _, depth, members, shared in self.nodes():
            own = np.maximum(np.concatenate([[-1], shared]), np.concatenate([shared, [-1]]))
            hit = own >= self.length - depth
            rows = members[hit]
            longest_left[rows] = np.maximum(longest_left[rows], own[hit])
            longest_right[rows] = np.maximum(longest_right[rows], depth)
        return longest_left, longest_right


def span_rows(length: int, gram: int, grouped: bool):
    """Spans repeat, tid, begin, end of rows sorted by key, whole keys at a time.

    ``grouped``: one span per maximal repeat group and occurrence, ``repeat`` being the hash of its bytes; else one
    per occurrence, with a null ``repeat``.
    """
    names = ("key", "low", "high", "copies", "left", "right", "context", "tid", "place")
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())

    def spans(held: dict[str, list]) -> pa.RecordBatch:
        _, group = np.unique(np.array(held["key"], np.int64), return_inverse=True)
        low, high, copies, left, right, place = (np.array(held[c], np.int64) for c in (*names[1:6], "place"))
        left, right = np.minimum(left, high), np.minimum(right, length - low)
        tree = Tree(group, left, right, held["context"], length, gram)
        out: tuple[list, ...] = ([], [], [], [])
        if grouped:
            for members, before, after in tree.groups():
                string = held["context"][members[0]][length - gram - before : length - gram + after]
                repeat = np.uint64(xxhash.xxh64_intdigest(string, seed=42)).astype(np.int64).item()
                for i in members.tolist():
                    for column, value in zip(out, (repeat, held["tid"][i], place[i] - before, place[i] + after), strict=True):
                        column.append(value)
        else:
            before, after = tree.reaches()
            whole = (copies > 1) & (left + right >= length)
            before, after = np.where(whole, left, before), np.where(whole, right, after)
            hit = np.flatnonzero(before >= 0)
            out = ([None] * len(hit), [held["tid"][i] for i in hit], (place - before)[hit], (place + after)[hit])
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], ["repeat", "tid", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {c: [] for c in names}
        for batch in batches:
            for c in names:
                held[c] += batch.column(c).to_pylist()
            if len(held["key"]) >= BATCH:
                keys = np.array(held["key"])
                whole = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
                if whole:
                    yield spans({c: v[:whole] for c, v in held.items()})
                    held = {c: v[whole:] for c, v in held.items()}
        if held["key"]:
            yield spans(held)

    return run


def small_spans(rows: DataFrame, length: int, gram: int, grouped: bool) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = rows.select("key", "low", "high", "copies", "left", "right", "context", "tid", "place")
    run = span_rows(length, gram, grouped)
    return given.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, "repeat long, tid binary, begin long, end long")


def beside(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with the ``n`` of their key; ``sizes`` is a stored table of key columns and the number n of their rows.

    Keys with more than 1 / HOT of all rows are fewer than HOT, so theirs are sent and their rows stay where they are.
    """
    on = [c for c in sizes.columns if c != "n"]
    total = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = F.broadcast(sizes.where(F.col("n") * HOT > total))
    rest = sizes.where(F.col("n") * HOT <= total).hint("merge")
    return rows.join(hot, on).union(rows.join(hot, on, "left_anti").join(rest, on))


def halved(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Both halves of the reaches of each row, keyed by the bytes that all strings of that half share.

    ``least`` and ``most`` are the reaches that the text of the row allows, ``code`` stands for all bytes they touch.
    """
    reach = length - gram
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    halves = F.array(F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high").alias("high")))
    split = rows.drop("n").withColumn("_half", F.explode(halves)).withColumn("low", F.col("_half.low")).withColumn("high", F.col("_half.high"))
    possible = split.drop("_half").where("low <= high and left >= low").where(F.col("right") >= length - F.col("high"))
    shared = F.substring("context", reach - F.col("low") + 1, length - F.col("high") + F.col("low"))
    bounded = possible.withColumns(
        {
            "key": F.xxhash64("key", "low", "high", shared),
            "least": F.greatest(F.col("low"), length - F.col("right")),
            "most": F.least("high", "left"),
        }
    )
    touched = F.substring("context", reach - F.col("most") + 1, length + F.col("most") - F.col("least"))
    return bounded.withColumns({"code": F.xxhash64("least", "most", touched), "repeat": F.xxhash64(touched)})


def all_spans(contexts: DataFrame, length: int, gram: int, group: int, grouped: bool) -> DataFrame:
    """repeat, tid, begin, end of all repeated strings, some overlapping."""
    rows = contexts.withColumn("low", F.lit(0)).withColumn("high", F.lit(length - gram))
    found = small_spans(rows.where(F.col("n") <= group), length, gram, grouped)
    large = rows.where(F.col("n") > group)
    while not large.isEmpty():
        split = halved(large, length, gram)
        marks = stored(split.select("key", "code", "repeat", "tid", "place", "copies", "least", "most"), "halves")
        kinds = stored(
            marks.groupBy("key", "code").agg(F.min(F.struct("tid", "place")).alias("rep"), F.sum("copies").alias("copies")), "kinds"
        )
        # rows equal in all that their half can reach repeat there in every string; one of them stands for all from here on
        alike = marks.where(F.lit(True) if grouped else F.col("copies") == 1)
        alike = beside(alike, kinds.where("copies > 1").select("key", "code", F.col("copies").alias("n")))
        begin, end = F.col("place") - F.col("most"), F.col("place") - F.col("least") + length
        whole = alike.select("repeat", "tid", begin.cast("long").alias("begin"), end.cast("long").alias("end"))
        sizes = stored(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
        kept = stored(
            beside(kinds, sizes).select("key", "code", "n", "copies", F.col("rep.tid").alias("tid"), F.col("rep.place").alias("place")), "open"
        )
        sent = hinted(kept, kept.count() <= SENT_ROWS)
        rest = split.drop("copies", "least", "most", "repeat").join(sent, ["key", "code", "tid", "place"]).drop("code")
        rest = stored(rest, "contexts")
        found = found.union(whole).union(small_spans(rest.where(F.col("n") <= group), length, gram, grouped))
        large = rest.where(F.col("n") > group)
    return found


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP, grouped: bool = False
) -> DataFrame:
    """repeat, tid (MD5 of a text) and the spans begin, end that repeated strings of ``length`` bytes cover."""
    texts = docs.select(text_id(), row_key(), data_bytes()).where(F.octet_length("data") >= length)
    marked = anchor_rows(texts, length, gram)
    known = stored(
        marked.groupBy("tid").agg(
            F.min("row").alias("row"), F.first("places").alias("places"), F.first("hashes").alias("hashes"), F.count(F.lit(1)).alias("copies")
        ),
        "anchors",
    )
    entries = known.select("tid", "row", "copies", F.explode(F.arrays_zip("places", "hashes")).alias("_a")).select(
        "tid", "row", "copies", F.col("_a.places").alias("place"), F.col("_a.hashes").alias("key")
    )
    counts = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("_all")).where("_all > 1").drop("_all")
    shared = beside(entries, stored(counts, "counts")).groupBy("tid").agg(
        F.first("row").alias("row"), F.first("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("place", "key", "n"))).alias("_a")
    )
    shared = stored(
        shared.select(
            "tid", "row", F.col("_a.place").alias("places"), F.col("_a.key").alias("keys"), F.col("_a.n").alias("counts"),
            F.transform("_a", lambda _: F.col("copies")).alias("weights"),
        ),
        "shared",
    )
    contexts = context_rows(texts_of(texts, shared), length, gram)
    bare = F.substring("context", F.lit(length - gram + 1) - F.col("left"), F.col("left") + F.col("right"))
    marks = stored(contexts.select("key", "tid", "place", "copies", "left", "right", F.xxhash64(bare).alias("code")), "contexts")
    same = ("key", "code", "left", "right")
    kinds = stored(
        marks.groupBy(*same).agg(F.min(F.struct("tid", "place")).alias("rep"), F.sum("copies").alias("copies")), "kinds"
    )
    whole = whole_contexts(marks, kinds.where("copies > 1").select(*same, F.col("copies").alias("n")), length)
    sizes = stored(kinds.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    left = beside(kinds, sizes).select("key", "n", "copies", F.col("rep.tid").alias("tid"), F.col("rep.place").alias("place"))
    packed = left.groupBy("tid").agg(F.sort_array(F.collect_list(F.struct("place", "key", "n", "copies"))).alias("_a"))
    names = (("place", "places"), ("key", "keys"), ("n", "counts"), ("copies", "weights"))
    packed = packed.join(shared.select("tid", "row"), "tid").select("tid", "row", *(F.col(f"_a.{x}").alias(y) for x, y in names))
    distinct = stored(context_rows(texts_of(texts, stored(packed, "open")), length, gram), "distinct")
    return whole.union(all_spans(distinct, length, gram, group, grouped))


def repeat_groups(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """repeat, n_bytes, tid, begin: every maximal repeat group of ``length`` bytes or more with its occurrences.

    ``repeat`` is the hash of the repeated bytes and ``tid`` the MD5 of a text that holds them from byte ``begin`` on. Repeats are followed
    to the ends of an anchor's context, so longer ones come as overlapping pieces. Places equal in all that their context
    or half can reach are a group of their own, and one of them stands for all in the groups of shorter strings. A text that
    stands more than once is listed once.
    """
    spans = repeated_spans(docs, length, gram, group, grouped=True)
    return spans.select("repeat", (F.col("end") - F.col("begin")).alias("n_bytes"), "tid", "begin").distinct()


def texts_of(texts: DataFrame, places: DataFrame) -> DataFrame:
    """One text per tid of ``places`` with its columns; equal texts in other rows are not looked up."""
    return texts.join(places.hint("merge"), ["tid", "row"])


def whole_contexts(marks: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """Spans of contexts that occur whole a second time: all strings through the anchor repeat there."""
    both = beside(marks, kinds).where(F.col("left") + F.col("right") >= length)
    begin, end = F.col("place") - F.col("left"), F.col("place") + F.col("right")
    return both.select(F.col("code").alias("repeat"), "tid", begin.cast("long").alias("begin"), end.cast("long").alias("end"))


def text_id() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("tid")


def data_bytes() -> Column:
    return F.coalesce("text", F.lit("")).cast("binary").alias("data")


def row_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("row")


def merged(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of sorted spans."""
    out: list[list[int]] = []
    for begin, end in spans:
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (remaining bytes) of every row."""
    spans = repeated_spans(docs, length, gram, group)
    per_text = stored(
        spans.groupBy("tid").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans")), "spans"
    )
    rows = docs.select("doc_id", text_id(), data_bytes()).join(per_text.hint("merge"), "tid", "left")

    def cut(column: pa.Array) -> list:
        out: list[list] = [[], [], [], []]
        for row in column.to_pylist():
            data, runs = row["data"], merged([(s["begin"], s["end"]) for s in row["spans"] or ()])
            ends = [0, *(x for run in runs for x in run), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
            for values, value in zip(out, (len(data), len(data) - len(kept), len(runs), kept), strict=True):
                values.append(value)
        return out

    given = rows.select("doc_id", F.struct("data", "spans").alias("_given"))
    return mapped(given, "_given", cut, {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept": "binary"})

