"""Jaccard join of shingle sets by prefixes of rare tokens and combinations of frequent ones.

Two sets link when ``100 * intersection >= percent * union``. Then they differ in at most ``d`` tokens, ``d`` being
the smaller size times (100 - percent) / percent, rounded down.

Tokens fall into ``CLASSES`` hash classes, whose tokens are counted over all documents. A class is frequent when its
count is far above what an even spread gives. Tokens are ordered by the count of their class, rarest
first, and a set of n tokens has a prefix of ``n - ceil(percent * n / 100) + 1``: two linked sets share a token there.

* Where the first shared token is rare, it is in both prefixes, and rare tokens of the prefix are indexed one by one.
* Otherwise the sets share no rare token at all, so all their rare ones are among the d that differ. Only sets whose
  prefix reaches a frequent token can be meant. Their prefix is extended to all their frequent tokens, which are dealt into
  more than d hash groups; each differing token spoils one group, so linked sets agree in all tokens of some
  group, and each group is indexed by the combination of its tokens.

Sets above ``RARE_SIZE`` tokens have long prefixes, in which tokens that are rare by themselves still meet by chance;
for them every class counts as frequent, so they are indexed by combinations of about six tokens alone. Frequent tokens, as those of
a common passage, never make a key of their own. Equal sets are one node, so sets of d = 0 need no key.

Most keys belong to one set alone. They are told apart first: tasks list sorted classes of their keys as differences, about two
bytes each, and what is met more than once sets a bit in a table of bounded size that is sent to all tasks; only keys that meet
a set bit are exchanged. A key that a few sets share by chance would, over many documents, chain all sets into one
group, so sets travel beside their keys with ``PARITY`` bits, each the parity of the tokens that fall there. Two sets differ
in at least as many tokens as bits, so pairs beyond the most tokens in which linked sets differ are left out without looking at tokens.

Pairs of sets that are left form coarse groups. A group is cut into blocks, and every pair of blocks is verified
exactly by one matrix product in a task that holds two blocks, which returns at most one link per set.
Components of these links are exact; no pairs of documents become rows. Tokens and sets are 64-bit hashes.

Defined cases: null text or no words give an empty set, which links with nothing, and component_id is the own doc_id;
fewer words than ``width`` are one token; a row with a null id takes part and its component_id is the smallest
other id reachable, null if there is none; repeated rows are copies; an empty table gives no rows; texts of any length are
hashed in blocks; ties between tokens go by their hash; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.llm.components import components
from trailmill.llm.shingling import mix, set_hash, shingle_sets
from trailmill.llm.storage import stored
from trailmill.scale import bounded_side, hinted

WIDTH = 3
PERCENT = 90
BLOCK = 1_024
#: Hash classes of tokens whose frequencies are counted, 8 bytes each in every task.
CLASSES = 1 << 18
#: Largest sets that are indexed by rare tokens of their prefix.
RARE_SIZE = 360
#: Most keys (16 bytes each) that are sent to all tasks.
SENT_KEYS = 2_000_000
#: Most sets with several rows (16 bytes each) that are sent to all tasks, so that one row stands for each of them.
SENT_COPIES = 4_000_000
#: Parity bits of a set, as 64-bit numbers.
PARITY = 256
#: Most bits, as a power of two, of the table that says which keys may be shared, and how many keys a task lists at once.
TABLE_BITS, LISTED = 28, 2_000_000
#: Most sets of one key that are compared pair by pair; beyond it all of them go into one coarse group.
TOGETHER = 4_096
#: Characters of the contract that are lower-cased, and what they become.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def token_class(tokens: np.ndarray, classes: int) -> np.ndarray:
    return (tokens >> np.uint64(20)).astype(np.int64) & (classes - 1)


def class_counts(docs: DataFrame, width: int, classes: int = CLASSES) -> np.ndarray:
    """Tokens of all documents per class; tasks add up their own before anything is exchanged."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes, dtype=np.int64)
        for batch in batches:
            for tokens in shingle_sets(batch.column("text"), width):
                np.add.at(total, token_class(tokens, classes), 1)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["class", "n"])

    sums = docs.select("text").mapInArrow(counted, "class int, n long").groupBy("class").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    out = np.zeros(classes, dtype=np.int64)
    out[table.column("class").to_numpy()] = table.column("n").to_numpy()
    return out


def frequent_above(counts: np.ndarray) -> float:
    """Count from which a class must hold a frequent token: six deviations and a few rows above the mean."""
    mean = counts.mean() if len(counts) else 0.0
    return float(mean + 6 * np.sqrt(mean) + 8)


def bands(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last size of each band of sizes, its number of hash groups, and the fewest tokens that index a group.

    Linked sets agree in an indexed group as long as more than d groups hold so many tokens, which fails
    for a set with a chance below 10^-12 at these numbers; ``group_keys`` then indexes smaller groups too.
    """
    rows, first = [], 1
    while first <= largest:
        last = max(first, first * 23 // 20)
        d = last * (100 - percent) // percent
        many = 4 * (d + 1) if d < 9 else 3 * (d + 1) // 2 + 3 if d < 20 else 5 * (d + 1) // 4 + 3
        rows.append((first, last, {0: 1, 1: 32, 2: 24}.get(d, many), 1 if d < 40 else 2 if d < 60 else 3))
        first = last + 1
    return tuple(np.array(x) for x in zip(*rows, strict=True))


def group_keys(tokens: np.ndarray, band: int, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and keys of the filled hash groups: a key is the combination of the tokens that fall into the group."""
    mixed = mix(tokens)
    place = ((mixed >> np.uint64(32)) * np.uint64(number) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(number, dtype=np.uint64)
    np.add.at(sums, place, mix(mixed))
    sizes = np.bincount(place, minlength=number)
    held = np.flatnonzero(sizes)
    return sizes[held], mix(sums[held] + held.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band))


class Index:
    """Keys of sets: two linked sets share at least one."""

    def __init__(self, percent: int, counts: np.ndarray):
        self.percent, self.counts, self.limit = percent, counts, frequent_above(counts)
        self.bands = bands(percent, 1 << 40)

    def keys(self, tokens: np.ndarray) -> np.ndarray:
        """Keys of a set, in its own band of sizes and in the one below if a link can reach there."""
        firsts, lasts = self.bands[:2]
        size = len(tokens)
        if not size:
            return np.zeros(0, dtype=np.int64)
        own = int(np.searchsorted(firsts, size, side="right")) - 1
        wanted = [own]
        if own and size * self.percent <= 100 * int(lasts[own - 1]):
            wanted.append(own - 1)
        found = [self.band_keys(tokens, band) for band in wanted]
        return np.concatenate(found).view(np.int64)

    def band_keys(self, tokens: np.ndarray, band: int) -> np.ndarray:
        _, lasts, groups, fewest = (int(x[band]) for x in self.bands)
        size, percent = len(tokens), self.percent
        d = min(size, lasts) * (100 - percent) // percent
        if not lasts * (100 - percent) // percent:
            return np.zeros(0, dtype=np.uint64)  # linked sets are equal here, hence one node
        singles, rest = np.zeros(0, dtype=np.uint64), tokens
        if lasts <= RARE_SIZE:
            seen = self.counts[token_class(tokens, len(self.counts))]
            order = np.lexsort((tokens, seen))
            prefix = size - (-(-size * percent // 100)) + 1
            rare = int(np.searchsorted(seen[order], self.limit, side="right"))
            singles = mix(tokens[order[: min(prefix, rare)]] + np.uint64(band + 1))
            if rare >= prefix:
                return singles
            rest = tokens[order[rare:]]
        sizes, combined = group_keys(rest, band, groups)
        enough = sizes >= fewest
        if enough.sum() <= d:
            enough[:] = True
        return np.concatenate([singles, combined[enough]])


def parity(tokens: np.ndarray) -> np.ndarray:
    """``PARITY`` bits as signed 64-bit numbers, each the parity of the number of tokens that fall there."""
    counts = np.bincount((tokens & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def row_key() -> Column:
    """Identity of a row: its id and a digest of its text."""
    text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)


def indexed(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, row, node, n_shingles, keys and parity bits of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = docs.sparkSession.sparkContext.broadcast(class_counts(docs, width))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(percent, counts.value)
        for batch in batches:
            nodes, sizes, keys, bits = [], [], [], []
            for tokens in shingle_sets(batch.column("text"), width):
                nodes.append(set_hash(tokens))
                sizes.append(len(tokens))
                keys.append(index.keys(tokens))
                bits.append(parity(tokens))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("row"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                    list_rows(keys), list_rows(bits),
                ],
                ["doc_id", "row", "node", "n_shingles", "keys", "parity"],
            )

    rows = docs.select("doc_id", row_key().alias("row"), "text")
    return rows.mapInArrow(keyed, f"doc_id {kind}, row string, node long, n_shingles long, keys array<long>, parity array<long>")


def list_rows(values: list[np.ndarray]) -> pa.ListArray:
    places = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(places, np.concatenate(values) if values else np.zeros(0, dtype=np.int64))


def differences(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, bytes of equal weight together, so that zeros of the high ones compress to nothing."""
    gaps = np.diff(values, prepend=np.uint64(0))
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def summed(data: bytes) -> np.ndarray:
    """The numbers of ``differences``."""
    planes = np.frombuffer(data, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def repeated(values: np.ndarray) -> np.ndarray:
    """Distinct numbers that come more than once among sorted ones."""
    return np.unique(values[1:][values[1:] == values[:-1]])


class Chosen:
    """Rows that stand for their sets: all but further rows of the sets that are named."""

    def __init__(self, copies: Broadcast):
        self.nodes, self.places = copies.value

    def __call__(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        if not len(self.nodes) or not batch.num_rows:
            return batch
        nodes, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "place"))
        at = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)
        return batch.filter(pa.array((self.nodes[at] != nodes) | (self.places[at] == places)))


def copied_sets(nodes: DataFrame) -> Broadcast:
    """Sets with several rows and the place of the row that stands for each, sorted and sent to all tasks; a bounded number of them."""
    table = nodes.where("copies > 1").select("node", F.xxhash64("row").alias("place")).limit(SENT_COPIES).toArrow()
    found = [table.column(c).to_numpy() for c in ("node", "place")]
    order = np.argsort(found[0])
    return nodes.sparkSession.sparkContext.broadcast(tuple(c[order] for c in found))


def shared_bits(rows: DataFrame, copies: Broadcast) -> Broadcast:
    """Bits by the leading bits of a key: set for every key that two sets share, and for few others.

    Keys fall into classes, some 128 times as many as there are keys, and a range of classes is looked through in one task.
    """
    total = rows.agg(F.sum(F.size("keys"))).first()[0] or 0
    spark, size = rows.sparkSession, int(total).bit_length()
    bits, table = max(10, min(size + 7, 62)), max(10, min(size + 2, TABLE_BITS))
    split = min(table - 3, max(total // LISTED, spark.sparkContext.defaultParallelism).bit_length())

    def listed(keys: list[np.ndarray]) -> pa.RecordBatch:
        values = np.sort(np.concatenate(keys).view(np.uint64) >> np.uint64(64 - bits))
        twice, once = repeated(values), np.unique(values)
        edges = np.arange((1 << split) + 1, dtype=np.uint64) << np.uint64(bits - split)
        cuts = [np.searchsorted(v, edges) for v in (once, twice)]
        held = np.flatnonzero(np.diff(cuts[0]))
        lists = [[differences(v[c[r] : c[r + 1]] - edges[r]) for r in held] for v, c in zip((once, twice), cuts, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), *(pa.array(x, pa.binary()) for x in lists)], ["part", "once", "twice"])

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, keys = Chosen(copies), []
        for batch in batches:
            keys.append(chosen(batch).column("keys").flatten().to_numpy())
            if sum(map(len, keys)) >= LISTED:
                yield listed(keys)
                keys = []
        if sum(map(len, keys)):
            yield listed(keys)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, list[list[np.ndarray]]] = {}
        for batch in batches:
            for part, *data in zip(*(batch.column(c).to_pylist() for c in ("part", "once", "twice")), strict=True):
                for held, some in zip(lists.setdefault(part, [[], []]), data, strict=True):
                    held.append(summed(some))
        for part, (once, twice) in lists.items():
            found = np.concatenate([repeated(np.sort(np.concatenate(once))), *twice])
            held = np.zeros(1 << (table - split), dtype=np.uint8)
            held[(found >> np.uint64(bits - table)).astype(np.int64)] = 1
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(held).tobytes()], pa.binary())], ["part", "bits"])

    given = rows.where("n_shingles > 0").select("node", F.xxhash64("row").alias("place"), "keys")
    parts = given.mapInArrow(listing, "part int, once binary, twice binary").repartition(1 << split, "part")
    out = np.zeros((1 << split, (1 << (table - split)) // 8), dtype=np.uint8)
    for part, data in zip(*(c.to_pylist() for c in parts.mapInArrow(met, "part int, bits binary").toArrow().columns), strict=True):
        out[part] = np.frombuffer(data, dtype=np.uint8)
    return spark.sparkContext.broadcast((table, out.ravel()))


def shared_entries(rows: DataFrame, copies: Broadcast, bits: Broadcast) -> DataFrame:
    """key, node, n and parity bits of the sets whose keys may be shared, one row of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, (table, held) = Chosen(copies), bits.value
        for batch in batches:
            batch = chosen(batch)
            keys = batch.column("keys").flatten().to_numpy()
            place = (keys.view(np.uint64) >> np.uint64(64 - table)).astype(np.int64)
            kept = np.flatnonzero(held[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1)
            owner = pc.list_parent_indices(batch.column("keys")).to_numpy()[kept]
            words = batch.column("parity").flatten().to_numpy().reshape(-1, PARITY // 64)[owner]
            given = batch.select(["node", "n_shingles"]).take(pa.array(owner)).columns
            yield pa.RecordBatch.from_arrays([pa.array(keys[kept]), *given, *(pa.array(w) for w in np.ascontiguousarray(words.T))], names)

    names = ["key", "node", "n", *(f"p{i}" for i in range(PARITY // 64))]
    given = rows.where("n_shingles > 0").select("node", "n_shingles", F.xxhash64("row").alias("place"), "keys", "parity")
    return given.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def joined(labels: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Labels, each the smallest position of a component, after further links."""
    a, b = np.concatenate(left), np.concatenate(right)
    while True:
        least = np.minimum(labels[a], labels[b])
        after = labels.copy()
        for ends in (a, b, labels[a], labels[b]):
            np.minimum.at(after, ends, least)
        after = after[after]
        if (after == labels).all():
            return labels
        labels = after


def near_labels(keys: np.ndarray, sizes: np.ndarray, words: np.ndarray, percent: int) -> np.ndarray:
    """For each row the smallest position of its component, where rows of one key whose parity bits allow a link are joined.

    Rows are sorted by key. Rows that are together already are not compared; a key with more rows than ``TOGETHER`` is one component.
    """
    labels = np.arange(len(keys))
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    counts = np.diff(np.append(begins, len(keys)))
    first, last = np.repeat(begins, counts), np.repeat(begins + counts, counts)
    large = np.repeat(counts > TOGETHER, counts)
    labels[large] = first[large]
    rows, shift, left, right, waiting = np.flatnonzero(~large & (last - first > 1)), 1, [], [], 0
    while len(rows := rows[rows + shift < last[rows]]):
        open_ = rows[labels[rows] != labels[rows + shift]]
        for begin in range(0, len(open_), 1 << 17):
            a = open_[begin : begin + (1 << 17)]
            b = a + shift
            apart = np.bitwise_count(words[a] ^ words[b]).sum(axis=1, dtype=np.int64)
            near = apart * (100 + percent) <= (sizes[a] + sizes[b]) * (100 - percent)
            left.append(a[near])
            right.append(b[near])
            waiting += int(near.sum())
        if waiting > len(keys) // 8:
            labels, left, right, waiting = joined(labels, left, right), [], [], 0
        shift += 1
    return joined(labels, left, right) if waiting else labels


def likely_links(percent: int):
    """Links (a, b) of sorted rows (key, node, n and parity bits): one row per set that may link with another one of its key."""

    def fresh(table: pa.Table) -> pa.Table:
        """Each set of a key once."""
        keys, nodes = (table.column(c).to_numpy() for c in ("key", "node"))
        return table.filter(pa.array(np.append(True, (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1]))))

    def links(table: pa.Table) -> pa.RecordBatch:
        keys, nodes, sizes, *words = (c.to_numpy() for c in fresh(table).columns)
        # unsigned: of a negative number the bits of its absolute value would be counted
        labels = near_labels(keys, sizes, np.stack(words, axis=1).view(np.uint64), percent)
        moved = np.flatnonzero(labels != np.arange(len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[labels[moved]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column("key").to_numpy()
            if not len(keys):
                continue
            begin = int(np.searchsorted(keys, keys[-1]))  # of the last key, which may go on
            if begin:
                yield links(pa.Table.from_batches([*held, batch.slice(0, begin)]))
                held = []
            elif held and held[-1].column("key")[-1].as_py() != keys[0]:
                yield links(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(begin))
            if sum(b.num_rows for b in held) > 2 * TOGETHER:
                table = fresh(pa.Table.from_batches(held))
                if table.num_rows > 2 * TOGETHER:  # a very common key: the rows so far are one group, the first ones stand for it
                    yield links(table)
                    table = table.slice(0, TOGETHER + 1)
                held = table.combine_chunks().to_batches()
        if held:
            yield links(pa.Table.from_batches(held))

    return run


def linked_labels(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the smallest position of its component under exact links."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    column = np.cumsum(first) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, 8192):
        part = slice(*np.searchsorted(column, [begin, begin + 8192]))
        here, place = np.unique(column[part], return_inverse=True)
        held = np.zeros((len(sets), len(here)), dtype=np.float32)
        held[owner[part], place] = 1
        common += held @ held.T
    common = np.rint(common).astype(np.int64)
    np.fill_diagonal(common, sizes)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    labels = np.arange(len(sets))
    while True:
        after = np.where(linked, labels[None, :], len(sets)).min(axis=1)
        after = after[after]
        if (after == labels).all():
            return labels
        labels = after


def verified(percent: int):
    """Links of sorted rows (place, node, tokens): one row per set that links with an earlier one of its place."""

    def links(nodes: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        labels = linked_labels(sets, percent)
        return [(nodes[i], nodes[at]) for i, at in enumerate(labels) if i != at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, nodes, sets = None, [], []
        for batch in batches:
            found = []
            column = batch.column("tokens")
            values, ends = column.values.to_numpy(), column.offsets.to_numpy()
            rows = zip(batch.column("place").to_pylist(), batch.column("node").to_pylist(), ends, ends[1:], strict=False)
            for here, node, a, b in rows:
                if here != place:
                    found += links(nodes, sets) if len(nodes) > 1 else []
                    place, nodes, sets = here, [], []
                if nodes and nodes[-1] == node:
                    continue
                nodes.append(node)
                sets.append(values[a:b].copy())
            yield pairs(found)
        yield pairs(links(nodes, sets) if len(nodes) > 1 else [])

    def pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def blocked(groups: DataFrame, block: int) -> DataFrame:
    """node, root and blocks: how many blocks the group of a node is cut into."""
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    return groups.join(sizes, "root")


def block_places() -> Column:
    """Places (hash of root and a pair of blocks) at which a node is compared."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    pair = F.transform(others, lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j")))
    return F.transform(pair, lambda p: F.xxhash64(F.col("root"), p["i"], p["j"]))


def token_rows(members: DataFrame, width: int) -> DataFrame:
    """node, root, blocks and tokens of every row with a text; equal nodes of a task once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh, sets = [], []
            for i, (node, tokens) in enumerate(zip(batch.column("node").to_pylist(), shingle_sets(batch.column("text"), width), strict=True)):
                if node not in seen:
                    seen.add(node)
                    fresh.append(i)
                    sets.append(tokens.view(np.int64))
            places = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64)
            kept = batch.select(["node", "root", "blocks"]).take(pa.array(fresh, pa.int32()))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.ListArray.from_arrays(places, flat)], ["node", "root", "blocks", "tokens"])

    return members.select("node", "root", "blocks", "text").mapInArrow(run, "node long, root long, blocks int, tokens array<long>")


def similar_sets(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """doc_id, row, n_shingles, node, node_id, root and component_id of every row."""
    if not 90 <= percent <= 100:
        raise ValueError("the numbers of hash groups are chosen for 90 to 100 percent")
    return linked_sets(docs, stored(indexed(docs, width, percent), "sets"), width, percent, block)


def common_keys(rows: DataFrame) -> DataFrame:
    """Links (a, b) of every set with the smallest one that shares a key."""
    entries = rows.select("node", F.explode("keys").alias("key"))
    ends = entries.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("most"))
    shared = stored(ends.where("b < most").drop("most"), "keys")
    return entries.join(hinted(shared, shared.count() <= SENT_KEYS), "key").select(F.col("node").alias("a"), "b")


def near_pairs(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join all pairs of sets which share a key and may link by their parity bits."""
    copies = copied_sets(nodes)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = shared_entries(rows, copies, shared_bits(rows, copies)).repartition(parts, "key")
    return entries.sortWithinPartitions("key", "node").mapInArrow(likely_links(percent), "a long, b long")


def linked_sets(docs: DataFrame, rows: DataFrame, width: int, percent: int, block: int) -> DataFrame:
    """Components of exact links among the sets of ``rows`` (doc_id, row, node, n_shingles, keys) that share a key.

    With the parity bits of the sets in ``rows``, only pairs that may link by these are looked at.
    """
    known = rows.where("n_shingles > 0").groupBy("node")
    nodes = stored(known.agg(F.min("doc_id").alias("node_id"), F.min("row").alias("row"), F.count(F.lit(1)).alias("copies")), "nodes")
    groups = components(near_pairs(rows, nodes, percent) if "parity" in rows.columns else common_keys(rows))
    members = bounded_side(blocked(groups, block).join(nodes.select("node", "row"), "node"))
    texts = docs.select(row_key().alias("row"), "text").join(members, "row")
    sets = token_rows(texts, width).select("node", "tokens", F.explode(block_places()).alias("place"))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = sets.repartition(parts, "place").sortWithinPartitions("place", "node").mapInArrow(verified(percent), "a long, b long")
    exact = components(links)
    smallest = (
        exact.join(nodes.select("node", "node_id"), "node").groupBy("root").agg(F.min("node_id").alias("component_id"))
    )
    found = exact.join(smallest, "root").select("node", "root", "component_id")
    known = nodes.select("node", "node_id").join(found, "node", "left")
    named = known.select(
        "node", "node_id", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "node_id").alias("component_id")
    )
    out = rows.drop("keys", "parity").join(named, "node", "left")
    return out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))


def one_per_component(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs``, columns unchanged: of each component one row stays, that with the smallest id, then smallest digest.

    Empty sets stay. Rows are told apart by id and text, so another text under the id of a row that stays
    is judged by itself, and of rows that repeat both one stays. Null ids come last.
    """
    found = stored(similar_sets(docs, width, percent).where("n_shingles > 0").select("doc_id", "row", "node", "root"), "judged")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = found.groupBy("root").agg(F.min(order)["row"].alias("row"))
    gone = found.select("row").distinct().join(first.select("row"), "row", "left_anti")
    again = found.groupBy("row").count().where("count > 1").join(first.select("row"), "row", "left_semi")
    names = docs.columns
    # most rows are told by a hash to be neither, and do not move
    marks = stored(gone.union(again.select("row")).select(F.xxhash64("row").alias("mark")).distinct(), "marks")
    marks = hinted(marks, marks.count() <= SENT_KEYS)
    rows = docs.select(F.struct(*names).alias("_docs_row"), row_key().alias("row")).withColumn("mark", F.xxhash64("row"))
    clear, rows = rows.join(marks, "mark", "left_anti"), rows.join(marks, "mark", "left_semi")
    rows = rows.join(bounded_side(gone), "row", "left_anti")
    again = bounded_side(again.select("row"))
    single = rows.join(again, "row", "left_anti")
    repeated = rows.join(again, "row", "left_semi").groupBy("row").agg(F.first("_docs_row").alias("_docs_row"))
    return clear.select("_docs_row.*").union(single.select("_docs_row.*")).union(repeated.select("_docs_row.*"))
