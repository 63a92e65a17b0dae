"""Embedding near-duplicates by product quantisation with an exact rerank.

Coarse centroids cut the vectors into lists, and each vector is kept as its list and one
code per subspace of its residual. A neighbour of a query that is nearer to centroid b than
to the query's own a lies beyond the plane between them, so a query reads the lists whose
planes are no further away than the probe depth. The depth is measured, not guessed: up to
``ASKED`` vectors are compared exactly with all rows, and it reaches the planes of all but one
in 10,000 of the pairs found, and a quarter further; nor is it less than what pairs made
right at the limit, in random directions, need. It never passes the limit's own distance,
beyond which no neighbour lies. A list whose radius ends before a neighbour can be is left
out as well. Within a list, distances to the codes are sums of table entries; a code's own
error, stored with it, bounds how far its vector may be nearer than its code, so this step
loses nothing. What it leaves is compared by exact cosine in double precision. So nearly all
pairs at the limit or above are found, and none below.

A pair that is found from one end only counts for both. Equal vectors are made one first,
with their number. Lists are cut into blocks of bounded size, a task holds one block of
members and streams the queries, and links leave as counts and as stars, never as all pairs.

Centroids and codes are fitted on a sample of at most ``SAMPLE`` vectors and ``PER_LIST`` a
list; everything else covers every row. The number of lists grows with the square root of
the number of vectors, up to ``MOST_LISTS``, which bounds what the driver and each task hold;
past that number's square, 16.7 million vectors, lists grow longer instead. No row is lost
by that, but a list costs its length times its queries.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing, and so do vectors of different lengths. Long or short vectors are scaled
before they are squared. Rows without id take part as neighbours, and have no component of
their own unless linked to one with an id. An empty table gives an empty result. Columns
other than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from rampline.llm.common import written
from rampline.llm.components import components, local_roots

LEAST_COSINE = 0.9
SAMPLE = 50_000
PER_LIST = 64
MOST_LISTS = 4096
ASKED = 2048  # vectors that the probe depth is measured with
MISSED = 1e-4  # share of the measured pairs that may lie beyond it
RANDOM_MISSED = 1e-3  # the same, of pairs made at the limit
HEADROOM = 1.25
BINS = 256
SUBSPACES = 8
CODES = 256
FIT_ROUNDS = 8
BLOCK = 4096
QUERIES_AT_ONCE = 256
SLACK = 1e-6  # for rounding of single-precision tables; reranking is exact


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1), 0.0)


def _in_blocks(rows: int, columns: int) -> Iterator[slice]:
    """Slices of rows whose matrix of so many columns stays within 16 MB."""
    step = max(1, (1 << 21) // max(1, columns))
    return (slice(at, at + step) for at in range(0, rows, step))


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    parts = [_distances(x[some], centres).argmin(1) for some in _in_blocks(len(x), len(centres))]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _fit(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres of ``x`` by Lloyd's rounds."""
    pick = np.random.default_rng(seed)
    centres = x[pick.choice(len(x), k, replace=k > len(x))].copy()
    for _ in range(FIT_ROUNDS):
        nearest = _nearest(x, centres)
        count = np.bincount(nearest, minlength=k)
        total = np.stack([np.bincount(nearest, column, k) for column in x.T], 1)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


class Quantiser:
    """Coarse centroids and residual codes of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int) -> None:
        self.coarse = _fit(sample, lists, 1)
        residual = sample - self.coarse[_nearest(sample, self.coarse)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [_fit(residual[:, p], min(CODES, max(1, len(sample))), 2 + i) for i, p in enumerate(self.parts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, codes, error of each code, and distance to the list's centroid."""
        own = _nearest(x, self.coarse)
        residual = x - self.coarse[own]
        codes = np.stack([_nearest(residual[:, p], b) for p, b in zip(self.parts, self.books, strict=True)], 1)
        rebuilt = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], 1)
        return own, codes.astype(np.uint8), np.linalg.norm(residual - rebuilt, axis=1), np.linalg.norm(residual, axis=1)

    def lists_to_read(
        self, x: np.ndarray, own: np.ndarray, radius: np.ndarray, depth: float, reach: float
    ) -> list[np.ndarray]:
        """The lists that each query reads: planes within ``depth``, and vectors within ``reach``.

        ``radius`` is the distance of each list's furthest vector from its centroid, negative if it has none.
        """
        out = []
        for some in _in_blocks(len(x), len(self.coarse)):
            far = _distances(x[some], self.coarse)
            gaps = np.sqrt(_distances(self.coarse[own[some]], self.coarse))
            beyond = (far - far[np.arange(len(far)), own[some]][:, None]) / np.where(gaps > 0, 2 * gaps, np.inf)
            near = (beyond <= depth + SLACK) & (np.sqrt(far) - radius <= reach + SLACK) & (radius >= 0)
            near[np.arange(len(far)), own[some]] = True
            out += [np.flatnonzero(row).astype(np.int32) for row in near]
        return out

    def depth_of(self, x: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How far each vector is from the plane between its list and one other."""
        out = np.empty(len(x))
        for some in _in_blocks(len(x), x.shape[1]):
            a, b = self.coarse[own[some]], self.coarse[other[some]]
            gaps = np.linalg.norm(b - a, axis=1)
            further = (b**2).sum(1) - (a**2).sum(1) - 2 * ((b - a) * x[some]).sum(1)
            out[some] = further / np.where(gaps > 0, 2 * gaps, np.inf)
        return out

    def pair_depth(self, x: np.ndarray, x_own: np.ndarray, y: np.ndarray, y_own: np.ndarray) -> np.ndarray:
        """The probe depth at which one end of each pair finds the other."""
        return np.maximum(0.0, np.minimum(self.depth_of(x, x_own, y_own), self.depth_of(y, y_own, x_own)))

    def random_depth(self, x: np.ndarray, cosine: float) -> float:
        """The probe depth for neighbours right at the limit, in random directions."""
        if x.shape[1] < 2:
            return 0.0
        aside = np.random.default_rng(5).normal(size=x.shape)
        aside -= (aside * x).sum(1, keepdims=True) * x
        aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-30)
        y = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * aside
        need = self.pair_depth(x, _nearest(x, self.coarse), y, _nearest(y, self.coarse))
        return float(np.quantile(need, 1 - RANDOM_MISSED))

    def tables(self, residual: np.ndarray) -> np.ndarray:
        """Squared distances of queries' residuals to every code: subspaces x queries x codes."""
        return np.stack([_distances(residual[:, p], b) for p, b in zip(self.parts, self.books, strict=True)])


def _reach(cosine: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def _usable(vector: Column) -> Column:
    """The vector, with no negative zeros; null if it links with nothing."""
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    valid = (F.size(vector) > 0) & ~odd & F.exists(vector, lambda v: v != 0)
    return F.when(valid, F.transform(vector, lambda v: F.when(v == 0, F.abs(v)).otherwise(v)))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of unit length, in double precision. They are scaled before they are squared."""
    if not len(column):
        return np.zeros((0, 0))
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


CODED = "list int, codes binary, error double, away double"


def _encoder(quantiser: Quantiser):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own, codes, error, away = quantiser.encode(_matrix(batch["v"]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["rep"], batch["n"], batch["v"], pa.array(own, pa.int32()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(away),
                ],
                ["rep", "n", "v", "list", "codes", "error", "away"],
            )

    return encode


def _measurer(quantiser: Quantiser, asked: np.ndarray, reps: np.ndarray, cosine: float):
    """Counts pairs of the ``asked`` with all rows by the probe depth that they need, in parts of the reach."""
    home = _nearest(asked, quantiser.coarse)
    reach = max(_reach(cosine), SLACK)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(BINS + 1, np.int64)
        for batch in batches:
            x, rep, own = _matrix(batch["v"]), batch["rep"].to_numpy(), batch["list"].to_numpy()
            for some in _in_blocks(len(x), len(asked)):
                row, column = np.nonzero(x[some] @ asked.T >= cosine)
                row += some.start
                other = rep[row] != reps[column]
                row, column = row[other], column[other]
                apart = own[row] != home[column]
                count[0] += np.count_nonzero(~apart)
                row, column = row[apart], column[apart]
                for part in _in_blocks(len(row), x.shape[1]):
                    r, c = row[part], column[part]
                    need = quantiser.pair_depth(x[r], own[r], asked[c], home[c])
                    bins = np.minimum(np.ceil(need / reach * BINS), BINS).astype(np.int64)
                    count += np.bincount(bins, minlength=BINS + 1)
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(count[seen])], ["bin", "pairs"])

    return measure


def probe_depth(coded: DataFrame, quantiser: Quantiser, cosine: float) -> float:
    """How far the planes of the lists to read may be, as measured; see the module."""
    total = coded.count()
    picked = coded.select("rep", "v").sample(min(1.0, 1.5 * ASKED / max(1, total)), 13).limit(ASKED).toArrow()
    if not picked.num_rows:
        picked = coded.select("rep", "v").limit(ASKED).toArrow()
    asked = _matrix(picked["v"].combine_chunks())
    measure = _measurer(quantiser, asked, picked["rep"].to_numpy(), cosine)
    counted = coded.select("rep", "v", "list").mapInArrow(measure, "bin int, pairs long")
    count = np.zeros(BINS + 1, np.int64)
    for row in counted.groupBy("bin").agg(F.sum("pairs").alias("pairs")).collect():  # at most BINS + 1 rows
        count[row["bin"]] = row["pairs"]
    reach = _reach(cosine)
    below = np.cumsum(count) >= (1 - MISSED) * count.sum()
    measured = HEADROOM * reach * below.argmax() / BINS
    return min(reach, max(measured, quantiser.random_depth(asked, cosine)))


def _asker(quantiser: Quantiser, radius: np.ndarray, depth: float, cosine: float):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = quantiser.lists_to_read(_matrix(batch["v"]), batch["list"].to_numpy(), radius, depth, _reach(cosine))
            kept = [batch[c] for c in ("rep", "n", "v", "list", "codes", "error")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(lists, pa.list_(pa.int32()))], ["rep", "n", "v", "home", "codes", "error", "lists"]
            )

    return ask


FOUND = "a long, b long, n long"


def _prober(quantiser: Quantiser, cosine: float):
    """Rows come by list and block, members first; yields counts (b null) and links (n null)."""
    reach = _reach(cosine)

    class Block:
        def __init__(self, number: int) -> None:
            self.list, self.parts = number, []

        def add(self, part: pa.RecordBatch) -> None:
            self.parts.append(part)

        def seal(self) -> None:
            whole = pa.Table.from_batches(self.parts).combine_chunks()
            self.rep, self.n = whole["rep"].to_numpy(), whole["n"].to_numpy()
            self.x = _matrix(whole["v"].combine_chunks())
            self.codes = np.frombuffer(b"".join(whole["codes"].to_pylist()), np.uint8).reshape(len(self.rep), -1)
            self.error = whole["error"].to_numpy()
            self.root = np.arange(len(self.rep))
            # which lists each member reads itself, as sorted numbers
            lists = whole["lists"].combine_chunks()
            reader = np.repeat(self.root, lists.value_lengths().to_numpy())
            self.reads = np.sort(reader * len(quantiser.coarse) + lists.flatten().to_numpy())
            self.unasked = np.zeros(len(self.rep), np.int64)
            self.parts = None

        def probe(
            self, rep: np.ndarray, x: np.ndarray, count: np.ndarray, home: np.ndarray
        ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Places of linked queries and members, and how many vectors each query is linked to here.

            A member that does not read the query's list counts the query here, as it will not find it.
            """
            tables = quantiser.tables(x - quantiser.coarse[self.list]).astype(np.float32)
            far = tables[0][:, self.codes[:, 0]]
            for i in range(1, len(tables)):
                far += tables[i][:, self.codes[:, i]]
            query, member = np.nonzero(np.sqrt(far) <= reach + self.error + 1e-3)
            exact = np.empty(len(query))
            for at in range(0, len(query), 1 << 16):
                part = slice(at, at + (1 << 16))
                exact[part] = np.einsum("ij,ij->i", x[query[part]], self.x[member[part]])
            good = (exact >= cosine) & (rep[query] != self.rep[member])
            query, member = query[good], member[good]
            wanted = member * len(quantiser.coarse) + home[query]
            at = np.minimum(np.searchsorted(self.reads, wanted), len(self.reads) - 1)
            missed = self.reads[at] != wanted
            np.add.at(self.unasked, member[missed], count[query[missed]])
            return query, member, np.bincount(query, self.n[member], len(rep)).astype(np.int64)

        def stars(self, rep: np.ndarray, query: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Joins members that a query links, and links each linked query to one member."""
            asked, at = np.unique(query, return_inverse=True)
            first = len(asked)
            joined = local_roots(first + len(self.rep), np.concatenate([at, np.arange(len(self.rep)) + first]),
                                 np.concatenate([member + first, self.root + first]))
            # of a component the smallest place may be a query; name it by its smallest member
            smallest = np.full(first + len(self.rep), len(self.rep))
            np.minimum.at(smallest, joined[first:], np.arange(len(self.rep)))
            self.root = smallest[joined[first:]]
            return rep[asked], self.rep[smallest[joined[:first]]]

        def close(self) -> Iterator[pa.RecordBatch]:
            moved = np.flatnonzero(self.root != np.arange(len(self.root)))
            yield rows(self.rep[moved], self.rep[self.root[moved]])
            counted = np.flatnonzero(self.unasked)
            yield rows(self.rep[counted], n=self.unasked[counted])

    def rows(a: np.ndarray, b: np.ndarray | None = None, n: np.ndarray | None = None) -> pa.RecordBatch:
        empty = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), empty if b is None else pa.array(b, pa.int64()),
             empty if n is None else pa.array(n, pa.int64())], ["a", "b", "n"],
        )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            number, part, asks = (batch[c].to_numpy() for c in ("list", "block", "asks"))
            cuts = np.flatnonzero((np.diff(number) != 0) | (np.diff(part) != 0) | (np.diff(asks) != 0)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(number)], strict=True):
                if at != (number[begin], part[begin]):
                    if block is not None and block.parts is None:
                        yield from block.close()
                    block, at = Block(int(number[begin])), (number[begin], part[begin])
                piece = batch.slice(begin, end - begin)
                if not asks[begin]:
                    block.add(piece)
                    continue
                if block.parts is not None:
                    if not block.parts:  # no member was dealt to this block
                        continue
                    block.seal()
                for start in range(0, end - begin, QUERIES_AT_ONCE):
                    some = piece.slice(start, QUERIES_AT_ONCE)
                    rep = some["rep"].to_numpy()
                    query, member, n = block.probe(rep, _matrix(some["v"]), some["n"].to_numpy(), some["home"].to_numpy())
                    if len(query):
                        yield rows(rep[n > 0], n=n[n > 0])
                        yield rows(*block.stars(rep, query, member))
        if block is not None and block.parts is None:
            yield from block.close()

    return probe


def _links(reps: DataFrame, cosine: float) -> DataFrame:
    """(a, b, n) among distinct vectors of one length."""
    spark = reps.sparkSession
    total = reps.count()
    lists = int(np.clip(np.sqrt(total), 1, MOST_LISTS))
    size = min(SAMPLE, max(PER_LIST * lists, PER_LIST * CODES))
    sample = reps.select("v").sample(min(1.0, 1.2 * size / max(1, total)), 7).limit(size).toArrow()
    if not sample.num_rows:
        sample = reps.select("v").limit(size).toArrow()
    lists = min(lists, sample.num_rows)
    quantiser = Quantiser(_matrix(sample["v"].combine_chunks()), lists)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = reps.schema["v"].dataType.simpleString()
    coded = f"rep long, n long, v {kind}, {CODED}"
    coded = written(reps.mapInArrow(_encoder(quantiser), coded), "pq-codes")

    blocks = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")
    sizes = written(coded.groupBy("list").agg(blocks, F.max("away").alias("radius")), "pq-lists")
    radius = np.full(lists, -1.0)
    for row in sizes.collect():  # at most MOST_LISTS rows
        radius[row["list"]] = row["radius"]
    sizes = F.broadcast(sizes.drop("radius"))
    ask = _asker(quantiser, radius, probe_depth(coded, quantiser, cosine), cosine)
    # written, so that members and queries agree on who reads what
    asking = f"rep long, n long, v {kind}, home int, codes binary, error double, lists array<int>"
    asking = written(coded.mapInArrow(ask, asking), "pq-asking")
    members = asking.withColumn("list", F.col("home")).join(sizes, "list").select(
        "list", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("asks"),
        "rep", "n", "v", "codes", "error", "lists",
    )
    queries = (
        asking.select("rep", "n", "v", "home", F.explode("lists").alias("list"))
        .join(sizes, "list")
        .select(
            "list", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("asks"),
            "rep", "n", "v", "home",
        )
    )
    return (
        members.unionByName(queries, allowMissingColumns=True)
        .repartition(partitions, "list", "block")
        .sortWithinPartitions("list", "block", "asks")
        .mapInArrow(_prober(quantiser, cosine), FOUND)
    )


def linked(table: DataFrame, cosine: float = LEAST_COSINE) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    vector = F.col("embedding")
    if table.schema["embedding"].dataType.simpleString() not in ("array<float>", "array<double>"):
        vector = vector.cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), _usable(vector).alias("v"))
    rows = written(rows.withColumn("h", F.xxhash64("v")), "pq-rows")
    distinct = rows.where("v is not null").groupBy("h", "v").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    distinct = written(distinct.withColumn("rep", F.monotonically_increasing_id()), "pq-distinct")
    lengths = [r[0] for r in distinct.select(F.size("v")).distinct().collect()]
    found = None
    for length in sorted(lengths):
        one = _links(distinct.where(F.size("v") == length).select("rep", "n", "v"), cosine)
        found = one if found is None else found.union(one)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    found = written(found, "pq-found")
    counts = found.where("n is not null").groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "rep")
    rooted = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    each = distinct.join(counts, "rep", "left").join(rooted, "rep", "left").select(
        "h", "v", "first", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("root", "rep").alias("root"),
    )
    each = written(each, "pq-each")
    least = written(each.groupBy("root").agg(F.min("first").alias("component_id")), "pq-least")
    named = written(each.join(least, "root").select("h", F.col("v").alias("same"), "n_links", "component_id"), "pq-named")
    joined = rows.join(named.withColumnRenamed("h", "same_h"), (F.col("h") == F.col("same_h")) & (F.col("v") == F.col("same")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
