"""Near-duplicate documents by SetSketch registers: band them, estimate by likelihood, confirm on the full sets.

A document's set holds the names of its distinct shingles. A register is floor(1 - log_b(x)), cut to [0, q + 1], where x is
the smallest of exponential variables (rate ``RATE``) drawn by hash for the elements of the set. Registers of a union are
the maxima of registers, and two registers are equal with probability close to the Jaccard similarity.

How links are found without listing all pairs of a group:

1. Equal sets become one class. All that follows is about classes.
2. Bands of registers put classes into buckets. Each bucket compares its members with one centre, the member that shares most
   buckets with others (for copies of one text usually the text itself). Estimates, then full sets, confirm links.
3. Components of these links are labelled. Where a bucket still holds several components, the members outside its largest
   one are compared with all members of other components, in blocks of bounded size; only pairs that the
   likelihood leaves open are returned, each from its first common band, and confirmed on full sets.

So every pair of classes that shares a bucket is linked, joined through others, or known not to be similar enough.
A pair of similarity 0.8 misses all 40 bands of 5 registers with probability 1.3e-7.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import map_batches, passing_columns, row_keys, stored
from tarn.llm.graph import components
from tarn.llm.kernels import LOWER, PIECE, SPACES, U64, batches_of, chained_names, join_texts, mix, prefix_names, substring_names, word_bounds

BASE = 1.001
RATE = 20.0
TOP = (1 << 16) - 1
REGISTERS = 400
BANDS = 40
ROWS = 5
BLOCK = 512
PAIRS = 1 << 18
_SEEDS = mix(np.arange(1, 2 * REGISTERS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)).reshape(2, REGISTERS)
_XOR, _TIMES = _SEEDS[0][:, None], (_SEEDS[1] | U64(1))[:, None]


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle names of each text; a text of fewer words is one shingle, none without words."""
    out: list[np.ndarray] = []
    bodies = [(t or b"").translate(LOWER) for t in texts]
    for part in batches_of([len(b) for b in bodies], PIECE):
        data, offsets = join_texts(bodies[part])
        starts, ends = word_bounds(data, SPACES)
        names = substring_names(prefix_names(data), starts, ends)
        chains = chained_names(names, words)
        first = np.searchsorted(starts, offsets)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= words:
                out.append(np.unique(chains[a:b - words + 1]))
            else:
                out.append(chained_names(names[a:b], b - a) if b > a else np.zeros(0, U64))
    return out


def registers(elements: np.ndarray) -> np.ndarray:
    """Registers of one non-empty set of names, as unsigned 16-bit integers."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, U64)
    for at in range(0, len(elements), 2048):
        drawn = elements[None, at:at + 2048] ^ _XOR
        drawn *= _TIMES
        np.minimum(least, drawn.min(axis=1), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0 ** 64) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarities of pairs of register rows, given the set sizes.

    The numbers of registers that are greater on one side, on the other, or equal are multinomial with chances that
    depend on the similarity; the likelihood is concave and is climbed by ternary search.
    """
    more = (a > b).sum(axis=-1)
    less = (a < b).sum(axis=-1)
    same = a.shape[-1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        p, q = np.maximum(chance(u - v * j), 1e-12), np.maximum(chance(v - u * j), 1e-12)
        return more * np.log(p) + less * np.log(q) + same * np.log(np.maximum(1 - p - q, 1e-12))

    low, high = np.zeros(np.shape(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        third = (high - low) / 3
        up = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(up, low + third, low), np.where(up, high, high - third)
    return (low + high) / 2


def reaches(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: float) -> np.ndarray:
    """Whether ``estimate`` gives at least ``least``: the likelihood is concave, so its slope there tells on which side the peak is."""
    more = (a > b).sum(axis=-1)
    less = (a < b).sum(axis=-1)
    same = a.shape[-1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    scale, k = np.log(BASE), (BASE - 1) / BASE
    possible = np.minimum(u / v, v / u) >= least
    x, y = np.maximum(u - v * least, 1e-12), np.maximum(v - u * least, 1e-12)
    p, q = -np.log1p(-x * k) / scale, -np.log1p(-y * k) / scale
    dp, dq = -v * k / (1 - x * k) / scale, -u * k / (1 - y * k) / scale
    return possible & (more * dp / p + less * dq / q - same * (dp + dq) / np.maximum(1 - p - q, 1e-12) >= 0)


def margin(threshold: float, sigmas: float) -> float:
    return threshold - sigmas * float(np.sqrt(threshold * (1 - threshold) / REGISTERS))


def _sketches(words: int):
    def run(batch: pa.RecordBatch):
        sets = shingle_sets(batch.column("body").to_pylist(), words)
        one = np.array([mix(s).sum(dtype=U64) for s in sets], U64)
        two = np.array([mix(s ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64) for s in sets], U64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row_id"), batch.column("row_hash"), pa.array([len(s) for s in sets], pa.int64()),
             pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
             pa.array([registers(s).astype(">u2").tobytes() if len(s) else None for s in sets], pa.binary())],
            names=["doc_id", "row_id", "row_hash", "n_shingles", "set_one", "set_two", "registers"])

    return run


def _full_sets(words: int):
    def run(batch: pa.RecordBatch):
        sets = shingle_sets(batch.column("body").to_pylist(), words)
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                         names=["node", "shingles"])

    return run


def _rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u2").astype(np.uint16).reshape(len(column), REGISTERS)


def _likely(least: float):
    def run(batch: pa.RecordBatch):
        got = reaches(_rows(batch.column("registers_a")), _rows(batch.column("registers_b")),
                      batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), least)
        yield batch.filter(pa.array(got)).select(["a", "b"])

    return run


def _open_pairs(least: float, threshold: int):
    """Per (band key, block): queries against members of other components whose sets are not too small or too large to reach the threshold."""
    def group(band: int, node, label, asks, size, four, fifth, regs):
        queries, members = np.flatnonzero(asks), np.flatnonzero(~asks)
        n = np.abs(size)
        for part in np.array_split(queries, -(-len(queries) * max(len(members), 1) // PAIRS)) if len(queries) else []:
            q, m = part[:, None], members[None]
            # of two members that both ask, the smaller one keeps the pair; the similarity is at most the ratio of the sizes
            wanted = ((label[m] != label[q]) & (node[m] != node[q]) & ((size[m] >= 0) | (node[m] > node[q]))
                      & (100 * np.minimum(n[m], n[q]) >= threshold * np.maximum(n[m], n[q])))
            x, y = np.nonzero(wanted)
            x, y = part[x], members[y]
            for at in range(0, len(x), BLOCK):
                a, b = x[at:at + BLOCK], y[at:at + BLOCK]
                first = ((four[a] == four[b]) & (fifth[a] == fifth[b])).argmax(axis=1) == band
                a, b = a[first], b[first]
                likely = reaches(regs[b], regs[a], n[b], n[a], least)
                yield node[a[likely]], node[b[likely]]

    def run(batches):
        held: list[pa.Table] = []

        def flush(table: pa.Table):
            key, block, band, node, label, size = (table.column(c).to_numpy() for c in ("key", "block", "band", "node", "label", "size"))
            asks = table.column("asks").to_numpy()
            regs = _rows(table.column("registers").combine_chunks())
            # the five registers of a band as one value of four and one of the fifth
            bands = regs[:, :BANDS * ROWS].reshape(len(regs), BANDS, ROWS)
            four, fifth = np.ascontiguousarray(bands[:, :, :4]).view(U64)[:, :, 0], np.ascontiguousarray(bands[:, :, 4])
            cut = np.flatnonzero((np.diff(key) != 0) | (np.diff(block) != 0)) + 1
            pairs = [(np.zeros(0, np.int64),) * 2]
            for a, b in zip([0, *cut], [*cut, len(key)]):
                pairs += group(band[a], *(v[a:b] for v in (node, label, asks, size, four, fifth, regs)))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in zip(*pairs)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            table = pa.concat_tables(held)
            key, block = table.column("key").to_numpy(), table.column("block").to_numpy()
            last = np.flatnonzero((key != key[-1]) | (block != block[-1]))
            ready = int(last[-1]) + 1 if len(last) else 0
            if ready:
                yield flush(table.slice(0, ready))
            held = [table.slice(ready)]
        if held and held[0].num_rows:
            yield flush(held[0])

    return run


def groups(docs: DataFrame, words: int = 4, threshold: int = 80) -> DataFrame:
    """(row_id, row_hash, doc_id, n_shingles, component_id, label): as ``near_duplicates``, with a label of each component (null
    without shingles) and the keys of ``row_keys``."""
    share = threshold / 100
    keyed = docs.select("doc_id", *row_keys(), F.col("text").cast("binary").alias("body"))
    kind = dict(docs.dtypes)["doc_id"]
    sketches = stored(map_batches(keyed, _sketches(words), f"doc_id {kind}, row_id long, row_hash long, n_shingles long, "
                                  "set_one long, set_two long, registers binary"), "sketches")
    same = ["set_one", "set_two", "n_shingles"]
    classes = stored(sketches.filter("n_shingles > 0").groupBy(*same)
                     .agg(F.min("doc_id").alias("first_id"), F.min(F.struct("row_id", "row_hash")).alias("row"), F.first("registers").alias("registers"))
                     .withColumn("node", F.monotonically_increasing_id()), "classes")

    band = F.posexplode(F.array(*[F.xxhash64(F.substring("registers", 2 * ROWS * i + 1, 2 * ROWS), F.lit(i)) for i in range(BANDS)])).alias("band", "key")
    banded = classes.select("node", band)
    shared = stored(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "keys")
    members = stored(banded.join(shared, "key"), "members")
    rank = members.groupBy("node").agg(F.sum("n").alias("popular"))
    centres = stored(members.join(rank, "node").groupBy("key").agg(F.max(F.struct("popular", "node"))["node"].alias("centre")), "centres")
    first_pairs = stored(members.join(centres, "key").filter("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "pairs")

    def with_registers(pairs: DataFrame) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("registers").alias(f"registers_{side}"),
                                              F.col("n_shingles").alias(f"n_{side}")), side)
        return pairs

    def confirmed(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        rows = classes.join(wanted, "node").select("node", "row.*")
        texts = keyed.join(rows, ["row_id", "row_hash"]).select("node", "body").dropDuplicates(["node"])
        sets = stored(map_batches(texts, _full_sets(words), "node long, shingles array<long>"), "sets")
        for side in "ab":
            pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"set_{side}")), side)
        both = F.size(F.array_intersect("set_a", "set_b"))
        return pairs.filter(100 * both >= threshold * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")

    alike = 100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b")
    likely = stored(map_batches(with_registers(first_pairs).filter(alike), _likely(margin(share, 6)), "a long, b long"), "likely")
    links = stored(confirmed(likely), "links")
    labels = components(links)

    labelled = stored(members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "labelled")
    per_label = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    split = stored(per_label.groupBy("key").agg(F.count(F.lit(1)).alias("n_labels"), F.max(F.struct("n", "label"))["label"].alias("largest"))
                   .filter("n_labels > 1").select("key", "largest"), "split")
    open_ = labelled.join(split, "key").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("asking", F.col("label") != F.col("largest"))
    open_ = stored(open_, "open")
    own = open_.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("asks", F.lit(False))
    asked = open_.filter("asking").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(True))
    columns = ["key", "block", "pos", "node", "label", "asks", "asking"]
    meeting = own.withColumnRenamed("band", "pos").select(columns).union(asked.withColumnRenamed("band", "pos").select(columns))
    meeting = (meeting.join(classes.select("node", "n_shingles", "registers"), "node")
               .select("key", "block", F.col("pos").alias("band"), "node", "label", "asks",
                       F.when(F.col("asking"), -F.col("n_shingles")).otherwise(F.col("n_shingles")).alias("size"), "registers")
               .repartition("key", "block").sortWithinPartitions("key", "block"))
    more = meeting.mapInArrow(_open_pairs(margin(share, 4.5), threshold), "a long, b long")
    tried = first_pairs.select("a", "b").union(first_pairs.select("b", "a"))
    more = stored(more.join(tried, ["a", "b"], "left_anti"), "open-pairs")
    labels = components(links.union(confirmed(more)))

    named = stored(classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")).select(*same, "first_id", "label"), "named")
    smallest = named.groupBy("label").agg(F.min("first_id").alias("smallest"))
    named = stored(named.join(smallest, "label").select(*same, F.col("smallest").alias("found_id"), "label"), "named")
    out = sketches.select("row_id", "row_hash", "doc_id", *same).join(named, same, "left")
    component = F.when(F.col("label").isNotNull(), F.col("found_id")).otherwise(F.col("doc_id"))
    return out.select("row_id", "row_hash", "doc_id", "n_shingles", component.alias("component_id"), "label")


def near_duplicates(docs: DataFrame, words: int = 4, threshold: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    Documents are linked if their sets of ``words``-word shingles (lower-cased A-Z) have a Jaccard similarity of ``threshold``
    percent or more; component_id is the smallest doc_id reachable, kept marks its document. Null and empty texts have
    no shingles and no links. Null doc_ids take part but never name a component; such rows are kept only if their
    component holds no doc_id. Repeated rows are copies with the same id, and all of those are kept or not. Other
    columns are ignored.
    """
    out = groups(docs, words, threshold)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@passing_columns("doc_id", "text")
def keep_one(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``: the one with the smallest doc_id, or by text hash if
    no row of the group has an id. Rows without shingles all stay; of repeated rows one stays."""
    rows = stored(groups(docs, words, threshold), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_id", "row_hash")
    first = rows.filter("label IS NOT NULL").groupBy("label").agg(F.min(order).alias("first")).select("first.row_id", "first.row_hash")
    kept = stored(first.union(rows.filter("label IS NULL").select("row_id", "row_hash")).distinct(), "kept")
    row_id, row_hash = row_keys()
    keyed = docs.select("*", row_id.alias("_row_id"), row_hash.alias("_row_hash"))
    kept = kept.withColumnsRenamed({"row_id": "_row_id", "row_hash": "_row_hash"})
    one = keyed.join(kept, ["_row_id", "_row_hash"], "left_semi")
    return one.dropDuplicates(["_row_id", "_row_hash"]).select(*docs.columns)
