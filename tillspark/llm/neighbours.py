"""Approximate nearest neighbours by inner product, over a neighbour graph.

NN-descent builds the graph. Vectors are sorted by the signs of random projections, several times over, and compared within blocks of
rows that follow each other; the best so found are each node's first links. Then neighbours of neighbours are joined, round after
round: at every node its links and its best reverse links meet with their codes and are compared pairwise where one of them is new,
and pairs that beat a node's last link replace it. Few changes end it. Queries walk the graph greedily: of the best nodes a query has
seen, those not yet expanded are joined with the graph, whose rows hold the codes of a node's neighbours and lie in buckets by node,
so that only the queries are shuffled; the walk ends where nothing better is left. What it found is scored exactly.

Inner products aren't a distance: each vector gets one more component that makes all norms equal, and queries get a zero there. Links
are compared by codes of 8 bits a component; results only by the original vectors, in double precision.

Equal vectors are one node, which remembers its smallest ids, k + 1 of them: no more can be in a result, so copies lose nothing and
make no hot node. A node has `links` links and half as many reverse ones in a round; nodes that many others link to keep their best.
Everything else is joined whole, and what a node or query gathers is bounded by these parameters. Each step is a written table.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those of another
length than the vector of the smallest id, and rows with a null id. Of rows that repeat an id the one with the smallest vector counts.
A query finds all candidates where they are fewer than k. An empty table gives an empty result. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, input_partitions, materialise, remove, scratch, tidy
from .vector_codes import finite

#: Rows of a sorted order that are compared with each other.
BLOCK = 512
#: Signs of projections that an order is sorted by.
SIGNS = 12
#: Vectors of the sample that projections are centred on and walks begin at.
SAMPLE = 2048
#: Rows that a step works on at once.
STEP = 256


@dataclass
class Index:
    """members (node, id, vector, place): up to k + 1 ids of each distinct vector, which is known by its first; lists: links of nodes."""

    members: DataFrame
    lists: DataFrame | None
    landmarks: np.ndarray  # codes by row, without their scale
    landmark_nodes: np.ndarray
    landmark_scales: np.ndarray
    largest: float
    links: int
    k: int


def encode(x: np.ndarray, extra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of 8 bits of vectors with one more component, and the scale of each."""
    whole = np.concatenate([x, extra[:, None]], 1)
    scale = np.abs(whole).max(1, initial=0) / 127
    return np.rint(whole / np.maximum(scale, 1e-300)[:, None]).astype(np.int8), scale.astype(np.float32)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _codes_of(column: pa.Array) -> np.ndarray:
    """Binary values of equal length as rows of 8-bit numbers."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.int8)[at[0] : at[-1]].reshape(len(column), -1)


def _binary(codes: np.ndarray) -> pa.Array:
    at = np.arange(len(codes) + 1, dtype=np.int32) * (codes.shape[1] if codes.ndim > 1 else 0)
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(codes))])


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values))


def taking_part(vectors: DataFrame, *, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of what is indexed: a row for each id."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(finite(F.col("vector")) & F.col("id").isNotNull())
    rows = rows.where(F.exists("vector", lambda x: x != 0)).groupBy("id").agg(F.min("vector").alias("vector"))
    first = rows.orderBy("id").select(F.size("vector")).first()
    return materialise(rows.where(F.size("vector") == (first[0] if first else 0)), "vectors")


def members_of(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors of (id, vector) with their k + 1 smallest ids: node (the smallest), id, vector, place."""
    over = "over (partition by vector order by id)"
    placed = rows.selectExpr("id", "vector", f"row_number() {over} as place", f"first_value(id) {over} as node")
    return materialise(placed.where(F.col("place") <= k + 1), "members")


def _first_links(nodes: DataFrame, centre: np.ndarray, *, orders: int, links: int, partitions: int, seed: int) -> DataFrame:
    """(node, other, score) of the best rows within blocks of each sorted order."""
    dim = len(centre)
    draws = np.random.default_rng(seed).standard_normal((orders, dim, SIGNS))
    bits = 1 << np.arange(SIGNS)[::-1]

    @tidy
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _codes_of(batch.column(1)) * batch.column(2).to_numpy()[:, None].astype(float) - centre
            for k in range(orders):
                p = x @ draws[k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), k, np.int32)), pa.array((p > 0) @ bits), pa.array(p[:, 0]), *(batch.column(c) for c in range(3))],
                    ["turn", "signs", "along", "node", "code", "scale"],
                )

    def best(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        node, scale = t["node"].to_numpy(), t["scale"].to_numpy()
        x = _codes_of(t["code"].chunk(0)).astype(np.float32)
        s = (x @ x.T) * (scale[:, None] * scale[None])
        np.fill_diagonal(s, -np.inf)
        n = min(links, len(node) - 1)
        i = np.argpartition(-s, n - 1, axis=1)[:, :n] if n else np.zeros((len(node), 0), int)
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(node, n)), pa.array(node[i].ravel()), pa.array(np.take_along_axis(s, i, 1).ravel())], ["node", "other", "score"])

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turn, n = [], None, 0
        for batch in batches:
            turns, a = batch.column(0).to_numpy(), 0
            while a < len(turns):
                if turns[a] != turn:
                    if held:
                        yield best(held)
                    held, turn, n = [], turns[a], 0
                b = min(a + BLOCK - n, int(np.searchsorted(turns, turn, side="right")))
                held.append(batch.slice(a, b - a))
                a, n = b, n + b - a
                if n == BLOCK:
                    yield best(held)
                    held, n = [], 0
        if held:
            yield best(held)

    keyed = nodes.select("node", "code", "scale").mapInArrow(keys, "turn int, signs long, along double, node long, code binary, scale float")
    order = ["turn", "signs", "along"]
    return keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(compare, "node long, other long, score float")


def _kept(found: DataFrame, nodes: DataFrame, links: int) -> DataFrame:
    """The best links of each node, of rows (node, other, score, fresh) that may repeat: a pair is fresh unless one of its rows isn't.

    Ranking is limited before rows are shuffled as well as after, so a node that many propose links to takes no more memory.
    """
    top = found.selectExpr("*", "dense_rank() over (partition by node order by score desc, other) as place").where(F.col("place") <= links)
    pairs = top.groupBy("node", "other").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    lists = pairs.groupBy("node").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "other", "fresh"))).alias("links"))
    last = F.when(F.size("links") >= links, -F.element_at("links", -1)["far"]).otherwise(F.lit(float("-inf"))).cast("float")
    return nodes.select("node", "code", "scale").join(lists, "node").withColumn("last", last)


def _both_ways(lists: DataFrame, links: int) -> DataFrame:
    """Links and the best half as many reverse links, as (centre, member, fresh)."""
    edges = lists.select("node", F.explode("links").alias("l")).select("node", F.col("l.other").alias("other"), F.col("l.far").alias("far"), F.col("l.fresh").alias("fresh"))
    back = edges.selectExpr("other as centre", "node as member", "fresh", "row_number() over (partition by other order by far, node) as place")
    return edges.select(F.col("node").alias("centre"), F.col("other").alias("member"), "fresh").unionByName(back.where(F.col("place") <= links // 2).drop("place"))


def _gathered(lists: DataFrame, links: int) -> DataFrame:
    """For each centre the array of its members with what the comparison needs: links and half as many at most; some are there twice."""
    info = lists.select(F.col("node").alias("member"), "code", "scale", "last")
    return _both_ways(lists, links).join(info, "member").groupBy("centre").agg(F.collect_list(F.struct("member", "fresh", "code", "scale", "last")).alias("with"))


def _members(column: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Of arrays of members: how many different ones each has, and their columns, one after the other; fresh if one of two is."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    member, fresh, code, scale, last = column.flatten().flatten()
    member, fresh, row = member.to_numpy(), fresh.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((~fresh, member, row))
    first = np.ones(len(order), bool)
    first[1:] = (np.diff(member[order]) != 0) | (np.diff(row[order]) != 0)
    at = order[first]
    return np.bincount(row[at], minlength=len(sizes)), (member[at], fresh[at], _codes_of(code)[at], scale.to_numpy()[at], last.to_numpy()[at])


@tidy
def _compare_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that members of a centre propose to each other: pairs with a fresh one that beat the last link."""
    for whole in batches:
        for start in range(0, whole.num_rows, STEP):
            sizes, (member, fresh, codes, scale, last) = _members(whole.column(0).slice(start, STEP))
            n, width = len(sizes), int(sizes.max(initial=0))
            row = np.repeat(np.arange(n), sizes)
            place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x, ids = np.zeros((n, width, codes.shape[1]), np.float32), np.full((n, width), -1, np.int64)
            new, need = np.zeros((n, width), bool), np.full((n, width), np.inf, np.float32)
            held = np.zeros((n, width), bool)
            size = np.zeros((n, width), np.float32)
            x[row, place], ids[row, place], size[row, place] = codes, member, scale
            new[row, place], need[row, place], held[row, place] = fresh, last, True
            score = np.matmul(x, x.transpose(0, 2, 1)) * (size[:, :, None] * size[:, None, :])
            good = (new[:, :, None] | new[:, None, :]) & held[:, :, None] & held[:, None, :] & (score > need[:, :, None])
            good[:, np.arange(width), np.arange(width)] = False
            c, i, j = np.nonzero(good)
            yield pa.RecordBatch.from_arrays([pa.array(ids[c, i]), pa.array(ids[c, j]), pa.array(score[c, i, j])], ["node", "other", "score"])


def build(rows: DataFrame, *, k: int = 20, links: int = 40, orders: int = 12, rounds: int = 6, settled: float = 0.08, seed: int = 11) -> Index | None:
    """The neighbour graph of taking_part(): rounds of NN-descent until at most `settled` of the links are new. None: no vectors."""
    members = members_of(rows, k)
    single = members.where("place = 1").select("node", "vector")
    sample = single.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).collect()
    if not sample:
        return None
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, largest = single.agg(F.count(F.lit(1)), F.sqrt(F.max(norm))).first()

    def coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x / largest
        return encode(x, np.sqrt(np.maximum(1 - (x * x).sum(1), 0)))

    @tidy
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c, scale = coded(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), _binary(c), pa.array(scale)], ["node", "code", "scale"])

    nodes = materialise(single.mapInArrow(codes, "node long, code binary, scale float"), "nodes")
    c, scale = coded(np.array([r["vector"] for r in sample], float))
    centre = (c * scale[:, None].astype(float)).mean(0)
    partitions = max(1, min(input_partitions(rows), -(-n * orders // (4 * BLOCK))))
    found = _first_links(nodes, centre, orders=orders, links=max(1, links // 2), partitions=partitions, seed=seed)
    lists = materialise(_kept(found.withColumn("fresh", F.lit(True)), nodes, links), "links")
    for _ in range(rounds):
        proposed = _gathered(lists, links).where(F.exists("with", lambda m: m["fresh"])).select("with").mapInArrow(_compare_members, "node long, other long, score float")
        had = lists.select("node", F.explode("links").alias("l")).select("node", F.col("l.other").alias("other"), (-F.col("l.far")).alias("score"), F.lit(False).alias("fresh"))
        after = materialise(_kept(proposed.withColumn("fresh", F.lit(True)).unionByName(had), nodes, links), "links")
        discard(lists)
        lists = after
        new, every = lists.select(F.explode("links.fresh").alias("f")).agg(F.count_if("f"), F.count(F.lit(1))).first()
        if new <= settled * every:
            break
    discard(nodes)
    return Index(members, lists, c, np.array([r["node"] for r in sample]), scale, largest, links, k)


def _bucketed(spark: SparkSession, index: Index) -> tuple[str, str]:
    """The graph for walks, as a table in buckets by node: members, their codes and scales. Its name and folder."""

    @tidy
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                sizes, (member, _, codes, scale, _) = _members(batch.column(1).slice(start, STEP))
                at = np.append(0, np.cumsum(sizes) * codes.shape[1]).astype(np.int32)
                joined = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(codes))])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, STEP), _lists(member, sizes), joined, _lists(scale, sizes)], ["node", "members", "codes", "scales"])

    buckets = input_partitions(index.lists)
    rows = _gathered(index.lists, index.links).select("centre", "with").mapInArrow(pack, "node long, members array<long>, codes binary, scales array<float>")
    name, path = f"neighbours_{uuid.uuid4().hex}", scratch(spark, "graph")
    rows.repartition(buckets, "node").write.bucketBy(buckets, "node").option("path", path).format("parquet").saveAsTable(name)
    return name, path


STATE = "q long, code binary, scale float, ids array<long>, scores array<float>, done array<boolean>, frontier array<long>, need float"


def _pools(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], pool: int, expand: int) -> list[pa.Array]:
    """State columns after ids, scores and done: the best `pool` of each query, and the next `expand` of them to expand."""
    ids, scores, done, frontier, need = [], [], [], [], []
    for i, s, d in rows:
        order = np.lexsort((~d, i))  # of equal ids the expanded one first
        i, s, d = i[order], s[order], d[order]
        one = np.diff(i, prepend=i[0] - 1 if len(i) else 0) != 0
        i, s, d = i[one], s[one], d[one]
        best = np.lexsort((i, -s))[:pool]
        i, s, d = i[best], s[best], d[best].copy()
        new = np.flatnonzero(~d)[:expand]
        d[new] = True
        ids.append(i)
        scores.append(s)
        done.append(d)
        frontier.append(i[new])
        need.append(s[-1] if len(s) == pool else -np.inf)
    cat = lambda x, kind: _lists(np.concatenate([np.zeros(0, kind), *x]).astype(kind), np.array([len(v) for v in x], np.int64))
    return [cat(ids, np.int64), cat(scores, np.float32), cat(done, bool), cat(frontier, np.int64), pa.array(np.array(need, np.float32))]


def _begin(index: Index, pool: int, expand: int, starts: int):
    """Walks begin at the nearest landmarks, and at the query's own node where it has one."""
    landmarks, landmark_nodes, landmark_scales, largest = index.landmarks, index.landmark_nodes, index.landmark_scales, index.largest

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP):
                batch = whole.slice(start, STEP)
                x = _matrix(batch.column(1)) / largest
                codes, scale = encode(x, np.zeros(len(x)))
                c = codes.astype(np.float32)
                s = (c @ landmarks.T.astype(np.float32)) * (scale[:, None] * landmark_scales[None])
                near = np.argsort(-s, axis=1, kind="stable")[:, :starts]
                own = batch.column(2).to_pylist()
                rows = []
                for k in range(len(x)):
                    ids, scores = landmark_nodes[near[k]], s[k, near[k]]
                    if own[k] is not None:  # expanded first
                        ids, scores = np.append(own[k], ids), np.append(np.float32(np.inf), scores)
                        keep = np.append(True, ids[1:] != own[k])
                        ids, scores = ids[keep], scores[keep]
                    rows.append((ids, scores, np.zeros(len(ids), bool)))
                yield pa.RecordBatch.from_arrays([batch.column(0), _binary(codes), pa.array(scale), *_pools(rows, pool, expand)], [f.split()[0] for f in STATE.split(", ")])

    return run


@tidy
def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a query at a node: those of its neighbours that beat what the query needs."""
    for whole in batches:
        for start in range(0, whole.num_rows, STEP):
            batch = whole.slice(start, STEP)
            q, code, scale, need, members, codes, scales = batch.columns
            sizes = members.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            x = _codes_of(code)
            at = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset : codes.offset + len(codes) + 1]
            y = np.frombuffer(codes.buffers()[2], np.int8)[at[0] : at[-1]].reshape(-1, x.shape[1])
            score = np.einsum("ij,ij->i", x.astype(np.float32)[row], y.astype(np.float32)) * (scale.to_numpy()[row] * scales.flatten().to_numpy())
            good = score > need.to_numpy()[row]
            kept = np.bincount(row[good], minlength=len(sizes))
            yield pa.RecordBatch.from_arrays([q, _lists(members.flatten().to_numpy()[good], kept), _lists(score[good].astype(np.float32), kept)], ["q", "found", "near"])


def _merge(pool: int, expand: int):
    """Pools with what their frontiers found."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, STEP):
                batch = whole.slice(start, STEP)
                parts = []
                for c in range(3, 8):
                    n = batch.column(c).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                    parts.append(np.split(batch.column(c).flatten().to_numpy(zero_copy_only=False), np.cumsum(n)[:-1]))
                rows = [(np.append(i, f), np.append(s, g).astype(np.float32), np.append(d, np.zeros(len(f), bool)).astype(bool)) for i, s, d, f, g in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), *_pools(rows, pool, expand)], [f.split()[0] for f in STATE.split(", ")])

    return run


def walk(index: Index, queries: DataFrame, *, pool: int = 192, expand: int = 64, starts: int = 16) -> DataFrame:
    """Pools of queries (q, vector, own: a node or null) after their walks: q, ids, scores by codes, best first."""
    spark = queries.sparkSession
    name, path = _bucketed(spark, index)
    state = materialise(queries.select("q", "vector", "own").mapInArrow(_begin(index, pool, expand, starts), STATE), "walks")
    graph = spark.table(name)
    while not state.where(F.size("frontier") > 0).isEmpty():
        steps = state.select("q", "code", "scale", "need", F.explode("frontier").alias("node"))
        at = graph.join(steps.hint("shuffle_hash"), "node").select("q", "code", "scale", "need", "members", "codes", "scales")
        found = at.mapInArrow(_expand, "q long, found array<long>, near array<float>")
        # A query's pool and what its frontier found meet in one shuffle: at most expand + 1 rows.
        both = state.select("q", "code", "scale", "ids", "scores", "done").unionByName(found, allowMissingColumns=True).groupBy("q")
        joined = both.agg(
            *[F.max(c).alias(c) for c in ("code", "scale")], *[F.max_by(c, F.size("ids")).alias(c) for c in ("ids", "scores", "done")], *[F.flatten(F.collect_list(c)).alias(c) for c in ("found", "near")]
        )
        after = materialise(joined.select("q", "code", "scale", "ids", "scores", "done", "found", "near").mapInArrow(_merge(pool, expand), STATE), "walks")
        discard(state)
        state = after
    spark.sql(f"DROP TABLE {name}")
    remove(spark, path)
    return state


def search(index: Index, queries: DataFrame, *, k: int | None = None, rescored: int = 3, **walking) -> DataFrame:
    """Per query (query_id, vector) its k nearest others: query_id, rank, vec_id, score. A row of the index isn't its own neighbour.

    queries: one row for each id, vectors as long as those of the index. `rescored` * k nodes of a pool are scored exactly.
    """
    k = k or index.k
    if k > index.k:
        raise ValueError(f"the index remembers ids for {index.k} neighbours")
    single = index.members.where("place = 1").select(F.col("node").alias("own"), F.col("vector").alias("_v"))
    asked = queries.select("query_id", "vector")
    # Equal query vectors walk once, under their smallest id.
    distinct = asked.groupBy("vector").agg(F.min("query_id").alias("q"))
    distinct = materialise(distinct.join(single, distinct["vector"].eqNullSafe(single["_v"]), "left").select("q", "vector", "own"), "queries")
    state = walk(index, distinct, **walking)
    pools = state.select("q", F.explode(F.slice("ids", 1, rescored * k + 1)).alias("node"))
    candidates = pools.join(index.members.select("node", "id", "vector"), "node").join(distinct.select("q", F.col("vector").alias("_q")), "q")
    product = F.aggregate(F.zip_with("_q", "vector", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, x: a + x)
    scored = candidates.select("q", "id", product.alias("score"))
    best = scored.selectExpr("*", "row_number() over (partition by q order by score desc, id) as place").where(F.col("place") <= k + 1)
    walked = distinct.select("q", F.col("vector").alias("_q"))
    by_query = asked.join(walked, asked["vector"] == walked["_q"]).select("query_id", "q").join(best.select("q", "id", "score"), "q").where("id <> query_id")
    ranked = by_query.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score desc, id) as int) as rank", "id as vec_id", "score")
    out = materialise(ranked.where(F.col("rank") <= k), "neighbours")
    discard(state, distinct)
    return out


def nearest_neighbours(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, every: int = 20, **building) -> DataFrame:
    """The k nearest rows by inner product of each row whose id is divisible by `every`: query_id, rank, vec_id, score."""
    rows = taking_part(vectors, id_col=id_col, vector_col=vector_col)
    index = build(rows, k=k, **building)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = search(index, rows.where(F.expr(f"id % {every} = 0")).select(F.col("id").alias("query_id"), "vector"))
    discard(rows, index.members, index.lists)
    return out
