"""Documents whose word shingles overlap, joined on parity sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.components import connected_components
from layerloom.llm.rows import ROW, with_row_key, wrapped
from layerloom.llm.words import RunHashes, lower_ascii, mixed, word_hashes
from layerloom.storage import staged

#: Words of documents that are worked on at a time; a longer document is worked on alone.
_CHUNK_WORDS = 1 << 17
#: 64-bit words of the short sketch that candidates are compared by.
_SHORT = 6
#: A scheme has more segments than it needs, by one in so many. Half of these may be left out by each
#: set, the others have to agree too.
_SPARE = 4
#: A band spans so many times what a set can reach: wider ones ask fewer sets for the keys of two schemes.
_REACHES = 2


class Bands:
    """Sizes of sets, cut so that linked sets lie in one band or in two adjacent ones.

    Scheme b finds the pairs whose larger set lies in band b. Their sets differ
    in ``limit(b)`` shingles at most, so of more segments than that one agrees.
    """

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must be 1 to 100")
        self.percent = percent
        self._starts = [1]

    def start(self, band: int) -> int:
        while len(self._starts) <= band:
            last = self._starts[-1]
            for _ in range(_REACHES):
                last = max(-(-100 * last // self.percent), last + 1)
            self._starts.append(last)
        return self._starts[band]

    def of(self, size: int) -> int:
        band = 0
        while self.start(band + 1) <= size:
            band += 1
        return band

    def limit(self, band: int) -> int:
        return differences(self.percent, 2 * (self.start(band + 1) - 1))

    def agreeing(self, size: int) -> int:
        """Keys that a set of this size shares at least with each smaller one that it is linked to.

        It grows with the size, so with a larger one it shares no fewer.
        """
        _, spare, left_out = _segments(self.limit(self.of(size)))
        return 1 + spare - left_out

    def schemes(self, size: int) -> list[int]:
        """Schemes that a set of this size takes part in: of its band, and of the next one if that is in reach."""
        band = self.of(size)
        reach = 100 * size >= self.percent * self.start(band + 1)
        # Without differences only equal sets are linked, and those are one already.
        return [b for b in (band, band + 1)[: 1 + reach] if self.limit(b) > 0]


def differences(percent: int, sizes: int) -> int:
    """Shingles in which two linked sets differ at most, from the sum of their sizes."""
    return (100 - percent) * sizes // (100 + percent)


def _segments(limit: int) -> tuple[int, int, int]:
    """Segments that are needed so that one agrees, more than that, and how many a set may leave out."""
    need = limit + 1
    spare = -(-need // _SPARE)
    return need, spare, spare // 2


def strongest(shingles: np.ndarray, scheme: int, limit: int) -> np.ndarray:
    """Keys of the segments of a parity sketch that the set is joined on.

    Every shingle flips about half of the 64 bits of one segment, those of its own
    hash, so a shingle that only one of two sets holds changes one segment, and
    segments that agree hold the same shingles: with one bit a shingle, those of
    few shingles would agree by chance, more often the more sets there are.
    Segments with the fewest shingles say least: the weakest are left out. The
    order is that of the segments' contents, so of the segments that two sets
    share both leave out the same ones first.
    """
    need, spare, left_out = _segments(limit)
    spread = mixed(shingles)
    segment = (((spread >> np.uint64(32)) * np.uint64(need + spare)) >> np.uint64(32)).astype(np.int64)
    sketch = np.zeros(need + spare, np.uint64)
    np.bitwise_xor.at(sketch, segment, mixed(spread))
    held = np.bincount(segment, minlength=need + spare)
    place = np.arange(need + spare, dtype=np.uint64) | np.uint64(scheme << 32)
    with np.errstate(over="ignore"):
        keys = mixed(sketch * np.uint64(0x9E3779B97F4A7C15) ^ mixed(place))
    return keys[np.lexsort((keys, held))[left_out:]]


def _short_sketch(shingles: np.ndarray) -> np.ndarray:
    place = ((mixed(~shingles) >> np.uint64(32)) * np.uint64(64 * _SHORT)) >> np.uint64(32)
    bits = np.bincount(place.astype(np.int64), minlength=64 * _SHORT) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Some rows at a time with the sorted hashes of their distinct shingles."""
    for batch in batches:
        texts, first, size, words = batch.column("text"), 0, 0, []
        for i in range(batch.num_rows):
            words.append(lower_ascii(texts[i].as_py() or b"").split())
            size += len(words[-1])
            if size >= _CHUNK_WORDS or i + 1 == batch.num_rows:
                sizes = np.fromiter(map(len, words), np.int64, len(words))
                ends = np.cumsum(sizes)
                runs = RunHashes(word_hashes([w for of_doc in words for w in of_doc]))
                sets = []
                for end, n in zip(ends.tolist(), sizes.tolist()):
                    at = np.arange(end - n, end - n + (max(n - shingle + 1, 1) if n else 0))
                    sets.append(np.unique(runs.of(at, np.minimum(at + shingle, end))))
                yield batch.slice(first, i + 1 - first), sets
                first, size, words = i + 1, 0, []


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _described(shingle: int, percent: int):
    """Size, two checksums, the short sketch and the least number of shared keys of each set."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for part, sets in _sets(batches, shingle):
            with np.errstate(over="ignore"):
                sums = np.array([mixed(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                other = np.array([mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
            short = np.concatenate([_short_sketch(s) for s in sets])
            offsets = pa.array(np.arange(len(sets) + 1) * _SHORT, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("row"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    _signed(sums),
                    _signed(other),
                    pa.ListArray.from_arrays(offsets, pa.array(short)),
                    pa.array([bands.agreeing(len(s)) if len(s) else 0 for s in sets], pa.int64()),
                ],
                names=["id", "row", "n", "sum", "other", "sketch", "agreeing"],
            )

    return kernel


def _keyed(shingle: int, percent: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for part, sets in _sets(batches, shingle):
            keys, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for row, found in zip(part.column("row").to_pylist(), sets):
                for scheme in bands.schemes(len(found)):
                    keys.append(strongest(found, scheme, bands.limit(scheme)))
                    rows.append(np.full(len(keys[-1]), row, np.int64))
            yield pa.RecordBatch.from_arrays([_signed(np.concatenate(keys)), pa.array(np.concatenate(rows))], names=["key", "node"])

    return kernel


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and node, with the first node of their key; keys of one node are left out."""
    key = first = held = None  # of the last row; held is a node whose key may go on
    for batch in batches:
        k, v = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        if not len(k):
            continue
        begins = np.r_[key is None or k[0] != key, k[1:] != k[:-1]]
        at = np.maximum.accumulate(np.where(begins, np.arange(len(k)), -1))
        firsts = np.where(at >= 0, v[at], 0 if first is None else first)
        several = ~begins | np.r_[~begins[1:], False]
        out = [k[several], v[several], firsts[several]]
        if held is not None and not begins[0]:
            out = [np.r_[x, y] for x, y in zip((key, held, held), out)]
        held = v[-1] if begins[-1] else None
        key, first = k[-1], firsts[-1]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["key", "node", "first"])


def _listed(shingle: int):
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, shingle):
            held = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("row"), held], names=["row", "shingles"])

    return kernel


def _verified(percent: int):
    """Those pairs whose sets overlap enough."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("shingles_u"), batch.column("shingles_v")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(keep), batch.column("v").filter(keep)], names=["u", "v"])

    return kernel


def _passed_over(agreeing: str) -> Column:
    """Frequent keys that a set leaves out of the last join; it grows with ``agreeing``."""
    return F.floor(F.col(agreeing) * 3 / 4)


class _Join:
    """Links between the distinct sets of a table."""

    def __init__(self, texts: DataFrame, nodes: DataFrame, shingle: int, percent: int):
        self._texts, self._nodes, self._shingle, self._percent = texts, nodes, shingle, percent

    def _texts_of(self, nodes: DataFrame) -> DataFrame:
        return self._texts.join(nodes, self._texts["row"] == nodes["node"], "left_semi")

    def _may_link(self) -> Column:
        """Whether sizes and short sketches (of u and of v) leave room for a link."""
        small, large = F.least("u.n", "v.n"), F.greatest("u.n", "v.n")
        apart = sum((F.bit_count(F.col("u.sketch")[i].bitwiseXOR(F.col("v.sketch")[i])) for i in range(_SHORT)), F.lit(0))
        room = F.floor((F.col("u.n") + F.col("v.n")) * (100 - self._percent) / (100 + self._percent))
        return (small * 100 >= large * self._percent) & (apart <= room)

    @staticmethod
    def _agreeing() -> Column:
        """Keys that a link of u and v shares at least."""
        return F.when(F.col("u.n") >= F.col("v.n"), F.col("u.agreeing")).otherwise(F.col("v.agreeing"))

    def _checked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) that are links, by their whole sets."""
        ends = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
        lists = staged(self._texts_of(ends).mapInArrow(_listed(self._shingle), "row bigint, shingles binary"), "lists")
        u = lists.select(F.col("row").alias("u"), F.col("shingles").alias("shingles_u"))
        v = lists.select(F.col("row").alias("v"), F.col("shingles").alias("shingles_v"))
        return pairs.join(u, "u").join(v, "v").mapInArrow(_verified(self._percent), "u bigint, v bigint")

    def _candidates(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) with n shared keys that sizes, sketches and n do not rule out, as (u, v, n)."""
        u, v = self._nodes.alias("u"), self._nodes.alias("v")
        met = pairs.alias("p").join(u, F.col("p.a") == F.col("u.node")).join(v, F.col("p.b") == F.col("v.node"))
        return met.filter(self._may_link() & (F.col("p.n") >= self._agreeing())).select(F.col("a").alias("u"), F.col("b").alias("v"), F.col("p.n").alias("n"))

    def links(self) -> DataFrame:
        """(u, v) pairs that connect what is linked, directly or over others.

        Each set is first compared with one other: of the first sets of its keys,
        the one that it shares most keys with. Then with the other first sets, if
        they are not in one component with it yet. Keys that still hold several
        components are joined for pairs across components, so no link is lost, and
        the copies of one text are not compared with each other. A link shares a
        number of keys; with fewer a pair is passed over, in the first steps as
        well, which see a part of its keys only. Pairs are counted before they meet
        sketches.
        """
        keys = self._texts_of(self._nodes.select("node")).mapInArrow(
            _keyed(self._shingle, self._percent), "key bigint, node bigint"
        )
        # One pass over sorted keys: a frequent key streams by, nothing of it is held.
        sorted_keys = keys.repartition("key").sortWithinPartitions("key", "node")
        met = staged(sorted_keys.mapInArrow(_buckets, "key bigint, node bigint, first bigint"), "met")
        # Dealt by node alone, the pairs are counted and meet their set without a second shuffle.
        stars = met.filter("node != first").repartition("node").groupBy("node", "first").agg(F.count(F.lit(1)).alias("n"))
        enough = stars.join(self._nodes.select("node", "agreeing"), "node").filter("n >= agreeing")
        pairs = enough.select(F.col("first").alias("a"), F.col("node").alias("b"), "n")
        near = staged(self._candidates(pairs), "stars")

        best = near.groupBy("v").agg(F.max(F.struct("n", (-F.col("u")).alias("u"))).alias("best"))
        tried = staged(best.select((-F.col("best")["u"]).alias("u"), "v"), "tried")
        linked = staged(self._checked(tried), "links")
        labels = connected_components(linked)
        others = staged(self._across(near.select("u", "v"), labels).join(tried, ["u", "v"], "left_anti"), "others")
        linked = staged(linked.union(self._checked(others)), "links")
        tried = tried.union(others)

        labels = connected_components(linked)
        named = met.drop("first").join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
        named = staged(named.select("key", "node", "label"), "named")
        several = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("often"))
        several = several.filter("low != high").select("key", "often")
        left = staged(self._rarest(named.join(several, "key")), "left")
        rest = left.join(self._nodes, "node")
        u, v = rest.alias("u"), rest.alias("v")
        across = (F.col("u.key") == F.col("v.key")) & (F.col("u.label") < F.col("v.label")) & self._may_link()
        low, high = F.least("u.node", "v.node").alias("u"), F.greatest("u.node", "v.node").alias("v")
        # Here all keys left that a pair shares meet, so their number decides.
        met = u.join(v, across).select(low, high, self._agreeing().alias("agreeing"))
        counted = met.groupBy("u", "v").agg(F.count(F.lit(1)).alias("n"), F.min("agreeing").alias("agreeing"))
        enough = counted.filter(F.col("n") >= F.col("agreeing") - _passed_over("agreeing")).select("u", "v")
        others = staged(enough.join(tried, ["u", "v"], "left_anti"), "others")
        return linked.union(staged(self._checked(others), "links"))

    def _rarest(self, keys: DataFrame) -> DataFrame:
        """The keys of sets that have as many as a link shares, without the most frequent ones of each set.

        Frequency orders keys alike for all sets. So of the keys that a link shares,
        both sets pass over the first ones in that order, together no more than the
        larger set does: ``agreeing`` less that number are left to the pair. The rows
        of a set are bounded by its shingles.
        """
        of_set = Window.partitionBy("node")
        ranked = keys.withColumn("place", F.row_number().over(of_set.orderBy(F.desc("often"), "key")))
        ranked = ranked.withColumn("held", F.count(F.lit(1)).over(of_set))
        kept = ranked.join(self._nodes.select("node", "agreeing"), "node")
        kept = kept.filter((F.col("held") >= F.col("agreeing")) & (F.col("place") > _passed_over("agreeing")))
        return kept.select("key", "node", "label")

    def _across(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """The pairs (u, v) that are not in one component."""
        of_u = labels.select(F.col("node").alias("u"), F.col("component").alias("label_u"))
        of_v = labels.select(F.col("node").alias("v"), F.col("component").alias("label_v"))
        found = pairs.join(of_u, "u", "left").join(of_v, "v", "left")
        apart = F.coalesce("label_u", "u") != F.coalesce("label_v", "v")
        return found.filter(apart).select("u", "v")


def overlapping(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 4,
    percent: int = 85,
) -> DataFrame:
    """(id, n, component) of every document.

    A document's set holds the distinct runs of ``shingle`` words of its text,
    A-Z in lower case. Documents are linked when 100 x intersection >= ``percent``
    x union; the component is the smallest id that can be reached over links,
    itself included. Shingles are told apart by 64-bit hashes, sets by their
    size and two 64-bit sums.

    Sets are hashed into parity sketches, whose segments of linked sets agree in
    at least one place: the join key. Candidates go on if the Hamming distance
    of a short sketch, which sets differ in no less than, leaves room for a link,
    and are then verified with their whole sets.

    - With fewer words than a shingle the whole sequence is the only one.
    - NULL and empty texts, and texts without a word, have an empty set and are linked with nothing.
    - Equal sets are one node, so copies are never compared with each other.
    - Repeated rows and ids give one row each; a NULL id gets the component of its
      class, which is NULL if no other row of the class has an id.
    - An empty table gives an empty result; further columns are ignored.
    """
    keyed = with_row_key(wrapped(docs, id_col, text_col), "id", ["text"])
    texts = keyed.select(F.col(ROW).alias("row"), F.col("text").cast("binary").alias("text"))
    kind = dict(keyed.dtypes)["id"]
    described = f"id {kind}, row bigint, n bigint, sum bigint, other bigint, sketch array<bigint>, agreeing bigint"
    sets = staged(
        keyed.select("id", F.col(ROW).alias("row"), F.col("text").cast("binary").alias("text")).mapInArrow(
            _described(shingle, percent), described
        ),
        "sets",
    )
    same = ["n", "sum", "other"]
    nodes = staged(
        sets.filter("n > 0")
        .groupBy(*same)
        .agg(F.min("row").alias("node"), F.min("id").alias("first"), F.min("sketch").alias("sketch"), F.min("agreeing").alias("agreeing")),
        "nodes",
    )
    labels = connected_components(_Join(texts, nodes.select("node", "n", "sketch", "agreeing"), shingle, percent).links())
    linked = nodes.select("node", "first").join(labels, "node")
    reached = linked.groupBy("component").agg(F.min("first").alias("reached"))
    of_node = linked.join(reached, "component").select("node", "reached")
    classes = staged(
        nodes.join(of_node, "node", "left").select(*same, F.coalesce("reached", "first").alias("component")), "classes"
    )
    found = sets.join(classes, same, "left")
    return found.select("id", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))
