"""Near-duplicate vectors by NN-descent.

A graph of each vector's nearest neighbours is started from a few random orders of the space (signs of random
projections) and refined: neighbours of a vector, in either direction, are compared with each other, and better ones
replace the worst of a list. A bounded audit compares some vectors with all others by brute force; refinement goes on
until the audited recall of links is reached. Graph edges over the threshold link vectors.

Lists that are full of links may hide more. A link that no list has joins two vectors with full lists, so groups with such
vectors are compared anew, as if their lists were as long as it takes: pivots with radii leave only groups that are near
enough, and these are compared member by member, in tiles of bounded size. The links of every group are counted in
tiles too, so no pair of a group is sent anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracewell.llm.common import components, forget, release, stored

THRESHOLD = 0.9
NEIGHBOURS = 10
#: Random orders the graph starts from, and projections that make one.
ORDERS = 8
PLANES = 24
#: Vectors compared at once.
CHUNK = 256
TILE = 1024
ROUNDS = (2, 8)
AUDITED = 256
RECALL, LEAST_RECALL = 0.995, 0.95


def unit(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as rows of unit length, in double precision, however large or small the numbers."""
    data = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    data = data / np.abs(data).max(axis=1, keepdims=True, initial=0.0)
    return data / np.linalg.norm(data, axis=1, keepdims=True)


def _best(name: np.ndarray, vec: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each vector the ``k`` closest of a chunk that are closer than its floor."""
    sim = vec @ vec.T
    np.fill_diagonal(sim, -2.0)
    sim[name[:, None] == name[None, :]] = -2.0
    k = min(k, len(name) - 1)
    if k < 1:
        return
    close = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    value = np.take_along_axis(sim, close, axis=1)
    i, j = np.nonzero((value > floor[:, None]) & (value > -2.0))
    yield name[i], name[close[i, j]], value[i, j]


def _compare(rows: DataFrame, k: int) -> DataFrame:
    """``(u, v, sim)`` from ``rows(key, name, vec, floor)``, sorted by key: chunks of one key's rows are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, name = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vec, floor = unit(batch.column(2)), batch.column(3).to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            found = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for at in range(a, b, CHUNK):
                    part = slice(at, min(b, at + CHUNK))
                    found += _best(name[part], vec[part], floor[part], k)
            u, v, s = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2 + (np.empty(0),)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(s)], ["u", "v", "sim"])

    return rows.mapInArrow(run, "u long, v long, sim double")


def _top(edges: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    one = edges.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def start_graph(nodes: DataFrame, dim: int, k: int, seed: int = 5) -> DataFrame:
    """Each vector's closest among its neighbours in a few random orders of the space."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).standard_normal((dim, ORDERS * PLANES))
        for batch in batches:
            side = (unit(batch.column(1)) @ planes > 0).reshape(-1, ORDERS, PLANES)
            code = side @ (1 << np.arange(PLANES - 1, -1, -1))
            for order in range(ORDERS):
                key = pa.array(np.full(batch.num_rows, order, np.int64))
                place = pa.array((np.int64(order) << 40) + code[:, order])
                yield pa.RecordBatch.from_arrays([key, batch.column(0), batch.column(1), pa.array(np.full(batch.num_rows, -2.0)), place], ["key", "name", "vec", "floor", "place"])

    kind = nodes.schema["vec"].dataType.simpleString()
    placed = nodes.select("name", "vec").mapInArrow(codes, f"key long, name long, vec {kind}, floor double, place long")
    # ranges also split a crowded place, as the name follows it
    placed = placed.repartitionByRange("place", "name").sortWithinPartitions("place", "name")
    return stored(_top(_compare(placed.drop("place"), k), k), "graph")


def refine(nodes: DataFrame, graph: DataFrame, k: int, turn: int) -> DataFrame:
    """One round: the neighbours of each vector, either way, are compared with each other."""
    floors = graph.groupBy("u").agg(F.min("sim").alias("low"), F.count("*").alias("n"))
    floors = floors.select(F.col("u").alias("name"), F.when(F.col("n") >= k, F.col("low")).otherwise(-2.0).alias("floor"))
    held = stored(nodes.select("name", "vec").join(floors, "name", "left").fillna(-2.0, ["floor"]), "held")
    around = graph.select(F.col("u").alias("key"), F.col("v").alias("name"))
    around = around.unionByName(graph.select(F.col("v").alias("key"), F.col("u").alias("name"))).distinct()
    mix = F.xxhash64("name", F.lit(turn)).alias("mix")
    rows = around.join(held, "name").select("key", "name", "vec", "floor", mix)
    rows = rows.repartitionByRange("key", "mix").sortWithinPartitions("key", "mix").drop("mix")
    new = stored(_top(graph.unionByName(_compare(rows, k)), k), "graph")
    forget(held)
    forget(graph)
    release(nodes.sparkSession)
    return new


def true_links(nodes: DataFrame, threshold: float) -> DataFrame:
    """``(u, n, rows)``: with how many others ``AUDITED`` vectors of ``nodes(name, vec, copies)`` are linked, and with how many
    rows of these, by comparison with all.

    The audited vectors are those with the smallest hashes; their number bounds the work.
    """
    some = nodes.select("name", "vec").orderBy(F.xxhash64("name")).limit(AUDITED).toArrow().combine_chunks()
    if not some.num_rows:
        return nodes.sparkSession.createDataFrame([], "u long, n long, rows long")
    name, vec = some["name"].to_numpy(), unit(some["vec"].chunk(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            other = batch.column(0).to_numpy()
            i, j = np.nonzero((vec @ unit(batch.column(1)).T >= threshold) & (name[:, None] != other[None, :]))
            rows = np.bincount(i, batch.column(2).to_numpy()[j], len(name)).astype(np.int64)
            count = np.bincount(i, minlength=len(name))
            yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(count), pa.array(rows)], ["u", "n", "rows"])

    counted = nodes.select("name", "vec", "copies").mapInArrow(run, "u long, n long, rows long")
    return stored(counted.groupBy("u").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")), "audited")


def recall_of(found: DataFrame, true: DataFrame) -> float:
    """The share of the ``true(u, n)`` links that ``found(u, has)`` counts."""
    both = true.join(found, "u", "left").select("n", F.least("n", F.coalesce("has", F.lit(0))).alias("has"))
    total, got = both.agg(F.sum("n"), F.sum("has")).first()
    return got / total if total else 1.0


def centres(members: DataFrame) -> DataFrame:
    """``(component, centre, low)`` of ``members(component, name, vec)``: the mean direction, and the least cosine of a member
    with it. Directions are summed in tasks before they are shuffled."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            vec = unit(batch.column(1))
            total = np.zeros((len(group), vec.shape[1]))
            np.add.at(total, at, vec)
            row, place = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group[row.ravel()]), pa.array(place.ravel().astype(np.int32)), pa.array(total.ravel())], ["component", "at", "x"]
            )

    parts = members.select("component", "vec").mapInArrow(sums, "component long, at int, x double")
    parts = parts.groupBy("component", "at").agg(F.sum("x").alias("x"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda p: p["x"])
    centre = stored(parts.groupBy("component").agg(listed.alias("centre")), "centres")

    def lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = np.einsum("ij,ij->i", unit(batch.column(1)), unit(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cos)], ["component", "cos"])

    sound = centre.where(F.exists("centre", lambda x: F.abs(x) > 1e-9))
    both = members.join(sound, "component").select("component", "vec", "centre")
    low = both.mapInArrow(lows, "component long, cos double").groupBy("component").agg(F.min("cos").alias("low"))
    # a group whose directions cancel out has no centre, and may be near anything
    none = F.transform("centre", lambda x: F.lit(1.0))
    return centre.join(low, "component", "left").select(
        "component", F.when(F.col("low").isNull(), none).otherwise(F.col("centre")).alias("centre"), F.coalesce("low", F.lit(-1.0)).alias("low")
    )


def _tiled(rows: DataFrame, spread: str, n: int) -> DataFrame:
    """The ``n`` rows once for each tile that they are in: ``i`` and ``j`` name a tile's sides of about ``TILE`` rows, ``second``
    tells which one a row is on."""
    blocks = max(1, -(-n // TILE))
    own = F.pmod(F.xxhash64(spread), F.lit(blocks)).cast("int")
    both = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return both.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other"), "second": F.col("own") > F.col("other")}).drop("own", "other")


def near_groups(centre: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: pairs of groups that may hold a link, as the angle of their centres is within the reach of both."""
    tiles = _tiled(centre, "component", centre.count()).repartition("i", "j")
    reach = np.arccos(threshold) + 1e-6

    def pairs(part: pd.DataFrame) -> pd.DataFrame:
        first, second = part[~part.second], part[part.second]
        if part.i.iloc[0] == part.j.iloc[0]:
            second = first
        x, y = (np.stack(p.centre.to_numpy()) if len(p) else np.empty((0, 1)) for p in (first, second))
        if not len(x) or not len(y):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
        wide = [np.arccos(np.clip(p.low.to_numpy(), -1, 1)) for p in (first, second)]
        i, j = np.nonzero(np.arccos(np.clip(x @ y.T, -1, 1)) <= wide[0][:, None] + wide[1][None, :] + reach)
        a, b = first.component.to_numpy()[i], second.component.to_numpy()[j]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b]

    return tiles.groupBy("i", "j").applyInPandas(pairs, "a long, b long").distinct()


def links_between(members: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """A link ``(a, b)`` for every pair of tiles of two groups of ``pairs(a, b)`` that has one."""
    size = members.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    size = stored(size, "sizes")
    parts = pairs.join(size.select(F.col("component").alias("a"), F.col("blocks").alias("m")), "a")
    parts = parts.join(size.select(F.col("component").alias("b"), F.col("blocks").alias("n")), "b")
    parts = parts.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    parts = stored(parts.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n") - 1))), "tiles")
    placed = members.join(size, "component").withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    rows = None
    for side, block, second in (("a", "i", False), ("b", "j", True)):
        on = (F.col(side) == F.col("component")) & (F.col(block) == F.col("own"))
        one = parts.join(placed, on).select("a", "b", "i", "j", "name", "vec", F.lit(second).alias("second"))
        rows = one if rows is None else rows.unionByName(one)

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        first, second = part[~part.second], part[part.second]
        if len(first) and len(second):
            x, y = (unit(pa.array(p.vec.tolist(), pa.list_(pa.float64()))) for p in (first, second))
            cos = x @ y.T
            i, j = np.unravel_index(int(np.argmax(cos)), cos.shape)
            if cos[i, j] >= threshold:
                return pd.DataFrame({"a": [first.name.iloc[i]], "b": [second.name.iloc[j]]})
        return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})

    return rows.groupBy("a", "b", "i", "j").applyInPandas(solve, "a long, b long")


def saturated_links(nodes: DataFrame, graph: DataFrame, group: DataFrame, threshold: float, k: int) -> DataFrame | None:
    """Links between the groups ``group(name, component)`` of the graph that full lists have hidden; None if no list is full."""
    full = graph.where(F.col("sim") >= threshold).groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    members = nodes.join(full.select(F.col("u").alias("name")), "name", "left_semi").join(group, "name")
    members = stored(members.select("component", "name", "vec"), "full")
    if members.isEmpty():
        return None
    pairs = stored(near_groups(stored(centres(members), "centres"), threshold), "near")
    links = stored(links_between(members, pairs, threshold), "hidden")
    for done in (members, pairs):
        forget(done)
    return links


def link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """``(name, links)``: with how many others of its group ``members(component, name, vec, copies)`` each is linked.

    Groups are cut into tiles of bounded size; a task compares a tile's two sides and sends on counts, not pairs.
    """
    size = members.groupBy("component").agg(F.count("*").alias("n"))
    blocks = stored(size.select("component", F.ceil(F.col("n") / TILE).cast("int").alias("blocks")), "blocks")
    own = members.join(blocks, "component").withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    tile = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tiles = own.select("component", "name", "vec", "copies", "own", tile).select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), "name", "vec", "copies"
    )
    keys = ["component", "i", "j"]
    tiles = tiles.repartition(*keys).sortWithinPartitions(*keys, "second")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(part: pa.Table) -> pa.RecordBatch:
            part = part.combine_chunks()
            name, copies = part["name"].to_numpy(), part["copies"].to_numpy()
            second, vec = part["second"].to_numpy(zero_copy_only=False), unit(part["vec"].chunk(0))
            i, j = part["i"].to_numpy(), part["j"].to_numpy()
            c = part["component"].to_numpy()
            cut = np.flatnonzero((np.diff(c) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            links = np.zeros(len(name), np.int64)
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(name)], strict=True):
                if i[a] == j[a]:
                    close = vec[a:b] @ vec[a:b].T >= threshold
                    np.fill_diagonal(close, False)
                    links[a:b] = close @ copies[a:b]
                else:
                    m = a + int((~second[a:b]).sum())
                    close = vec[a:m] @ vec[m:b].T >= threshold
                    links[a:m], links[m:b] = close @ copies[m:b], copies[a:m] @ close
            return pa.RecordBatch.from_arrays([part["name"].chunk(0), pa.array(links)], ["name", "links"])

        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            last = [table[k][-1].as_py() for k in keys]
            same = np.ones(table.num_rows, np.bool_)
            for k, v in zip(keys, last, strict=True):
                same &= table[k].to_numpy() == v
            stop = int(np.argmax(same))
            if stop:
                yield solve(table.slice(0, stop))
            rest = table.slice(stop)
        if rest is not None and rest.num_rows:
            yield solve(rest)

    return tiles.mapInArrow(run, "name long, links long").groupBy("name").agg(F.sum("links").alias("links"))


def nn_descent(
    nodes: DataFrame, dim: int, true: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS
) -> DataFrame:
    """The neighbour graph ``(u, v, sim)`` of ``nodes(name, vec)``, refined until it has the links of the audited vectors
    ``true(u, n)``, of one with more than ``k`` so many."""
    graph = start_graph(nodes, dim, k)
    due = true.select("u", F.least("n", F.lit(k)).alias("n"))
    for turn in range(1, ROUNDS[1] + 1):
        graph = refine(nodes, graph, k, turn)
        has = graph.where(F.col("sim") >= threshold).groupBy("u").agg(F.count("*").alias("has"))
        if turn >= ROUNDS[0] and recall_of(has, due) >= RECALL:
            break
    return graph


def grouped_links(nodes: DataFrame, dim: int, threshold: float, k: int) -> DataFrame:
    """``(name, component_id, links)`` of the vectors of ``nodes(name, vec, copies, first)`` that are linked with others.

    The links counted are audited as a whole; if they fall short of ``LEAST_RECALL`` the search is repeated with lists twice
    as long, and fails if that doesn't mend it.
    """
    true = true_links(nodes, threshold)
    for size in (k, 2 * k, 4 * k):
        graph = nn_descent(nodes, dim, true, threshold, size)
        linked = graph.where(F.col("sim") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b"))
        group = stored(components(linked).withColumnRenamed("node", "name"), "group")
        hidden = saturated_links(nodes, graph, group, threshold, size)
        if hidden is not None:
            group = stored(components(linked.unionByName(hidden)).withColumnRenamed("node", "name"), "group")
        members = stored(nodes.join(group, "name"), "members")
        counts = stored(link_counts(members.select("component", "name", "vec", "copies"), threshold), "counts")
        recall = recall_of(counts.select(F.col("name").alias("u"), F.col("links").alias("has")), true.select("u", F.col("rows").alias("n")))
        if recall >= LEAST_RECALL:
            break
    else:
        raise RuntimeError(f"only {recall:.3f} of the audited links were found")
    names = stored(members.groupBy("component").agg(F.min("first").alias("component_id")), "names")
    found = members.select("name", "component").join(names, "component").join(counts, "name")
    found = stored(found.select("name", "component_id", "links"), "found")
    for done in (graph, group, members, counts, true):
        forget(done)
    release(nodes.sparkSession)
    return found


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, k: int = NEIGHBOURS
) -> DataFrame:
    """One row per input row: ``id, n_links, component_id, kept``; vectors of one length are compared, whatever their labels.

    Null, empty and zero vectors and those with null or non-finite components link with nothing. Equal vectors are one
    node with a count and link with each other. Every row counts, repeated ones too. A component is named by its
    smallest id; null ids take part but name nothing. Extra columns are ignored; an empty table gives no rows.
    """
    sound = F.forall(F.col("vec"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    alive = sound & F.exists(F.col("vec"), lambda x: x != 0)
    exact = isinstance(table.schema[vec_col].dataType.elementType, (T.FloatType, T.ByteType, T.ShortType))
    vec = F.col(vec_col).cast("array<float>" if exact else "array<double>")
    rows = table.select(F.col(id_col).alias("id"), vec.alias("vec"))
    rows = rows.withColumn("name", F.when(F.coalesce(alive, F.lit(False)), F.xxhash64("vec")))
    nodes = rows.where("name is not null").groupBy("name").agg(
        F.first("vec").alias("vec"), F.count("*").alias("copies"), F.min("id").alias("first")
    )
    nodes = stored(nodes, "nodes")
    out = None
    for (dim,) in nodes.select(F.size("vec")).distinct().collect():
        found = grouped_links(nodes.where(F.size("vec") == dim), dim, threshold, k)
        out = found if out is None else out.unionByName(found)
    joined = rows.select("id", "name").join(nodes.select("name", "copies", "first"), "name", "left")
    if out is None:
        joined = joined.withColumns({"component_id": F.lit(None).cast(table.schema[id_col].dataType), "links": F.lit(0).cast("long")})
    else:
        joined = joined.join(out, "name", "left")
    component = F.coalesce("component_id", "first", "id")
    return joined.select(
        "id",
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
