"""Near duplicates among vectors by product quantisation.

A coarse quantiser deals unit vectors into inverted lists; what remains of a vector after its list's centre is
cut into subspaces, each coded by the nearest of 256 centres. A query's similarity with a whole list
is read from tables: its product with the list's centre, plus one table entry per subspace. A member's code is
off by a known length, so no member that could reach the threshold is passed over within a list. Candidates are
compared exactly, in double precision.

A query probes its own list, and every list whose border with its own is nearer than ``margin``. A
vector within reach of the query (a distance of ``sqrt(2 - 2 * threshold)``) has to lie beyond that border
to be in the other list; a margin of that whole reach would find every link. How much of a step points straight across a border depends on
how many directions the vectors really have. So the margin is fitted: steps of the whole reach are taken from vectors of
the sample towards their neighbours, and the margin is what all but a few thousandths of these steps would need. Recall
against brute force, by rank of the vectors, is part of the tests and stands in the README.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from lamina.llm.common import small_batches, stash
from lamina.llm.components import components
from lamina.operators.joins import lookup_join

THRESHOLD = 0.95

# The size of the sample that the quantisers are fitted on, the most lists there can be, and the codes.
SAMPLE = 16_384
MOST_LISTS = 4_096
SUBSPACES = 8
CODES = 256
ROUNDS = 8

# Vectors of one list that are compared at a time, on either side, if they have no more than DIMENSIONS, else fewer; rows of
# a product, and pairs compared exactly, at a time.
BLOCK = 4096
DIMENSIONS = 1024
STRIP = 256
PAIRS = 1 << 16

# Vectors of the sample that steps are taken from, steps from each, lists whose border they may cross, and the share of steps that may need a wider margin.
STEPPED = 512
STEPS = 8
MISSED = 0.004


@dataclass(frozen=True)
class Quantiser:
    """``centres``: lists x dimensions; ``codes``: one table of centres per subspace, of the columns in ``cuts``."""

    centres: object
    codes: list
    cuts: list[int]


def _clustered(rows, many: int, rounds: int, seed: int):
    """Centres of ``rows`` by Lloyd's iterations from a fixed start; an empty cluster keeps its centre."""
    import numpy as np

    pick = np.random.default_rng(seed).permutation(len(rows))[:many]
    centres = rows[np.sort(pick)].copy()
    for _ in range(rounds):
        near = _nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        sizes = np.bincount(near, minlength=len(centres))
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def _nearest(rows, centres):
    import numpy as np

    half = (centres**2).sum(axis=1) / 2
    parts = [(rows[i : i + 4096] @ centres.T - half).argmax(axis=1) for i in range(0, len(rows), 4096)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def fit(sample, lists: int, subspaces: int = SUBSPACES, codes: int = CODES) -> Quantiser:
    """Quantisers of a bounded sample of unit vectors."""
    import numpy as np

    centres = _clustered(sample, lists, ROUNDS, 1)
    rest = sample - centres[_nearest(sample, centres)]
    cuts = [sample.shape[1] * i // min(subspaces, sample.shape[1]) for i in range(min(subspaces, sample.shape[1]) + 1)]
    tables = [_clustered(np.ascontiguousarray(rest[:, a:b]), codes, ROUNDS, 2 + a) for a, b in zip(cuts, cuts[1:])]
    return Quantiser(centres, tables, cuts)


def _borders(rows, own, other, centres):
    """How far the rows are from the border between the lists ``own`` and ``other``."""
    import numpy as np

    a, b = centres[own], centres[other]
    between = np.sqrt(np.maximum(((a - b) ** 2).sum(axis=1), 1e-18))
    return (((rows - b) ** 2).sum(axis=1) - ((rows - a) ** 2).sum(axis=1)) / (2 * between)


def fitted_margin(sample, centres, reach: float) -> float:
    """The margin that all but a share of ``MISSED`` of the steps of length ``reach`` need, of steps from vectors of the sample.

    Steps lead towards the nearest vectors of the sample that are apart and towards others at random, so they have the directions
    that the vectors have. A link is found if either end probes the other's list.
    """
    import numpy as np

    if len(sample) < 3:
        return reach
    draw = np.random.default_rng(7)
    start = sample[np.sort(draw.permutation(len(sample))[:STEPPED])]
    distance = 2 - 2 * start @ sample.T
    distance[distance < 1e-9] = np.inf
    many = min(STEPS, len(sample) - 1)
    near = np.argpartition(distance, many - 1, axis=1)[:, :many]
    others = np.concatenate([near, draw.integers(0, len(sample), near.shape)], axis=1)
    begin = np.repeat(start, others.shape[1], axis=0)
    step = sample[others.ravel()] - begin
    size = np.linalg.norm(step, axis=1)
    begin, step = begin[size > 1e-6], step[size > 1e-6] / size[size > 1e-6, None]
    if not len(begin):
        return reach
    end = begin + reach * step
    end /= np.linalg.norm(end, axis=1, keepdims=True)
    a, b = _nearest(begin, centres), _nearest(end, centres)
    needed = np.minimum(_borders(begin, a, b, centres), _borders(end, b, a, centres))
    return float(min(reach, np.quantile(np.where(a == b, 0, needed), 1 - MISSED)))


def _encode(rows, model: Quantiser, margin: float):
    """Own list, codes, the length that the code is off by, and the probed lists of unit vectors, for any number of rows."""
    import numpy as np

    parts = [_encode_strip(rows[i : i + STRIP], model, margin) for i in range(0, len(rows), STRIP)]
    own, codes, off, probed = zip(*parts)
    return np.concatenate(own), np.concatenate(codes), np.concatenate(off), [p for part in probed for p in part]


def _encode_strip(rows, model: Quantiser, margin: float):
    import numpy as np

    own = _nearest(rows, model.centres)
    rest = rows - model.centres[own]
    codes = np.empty((len(rows), len(model.codes)), np.uint8)
    off = np.zeros(len(rows))
    for m, (a, b) in enumerate(zip(model.cuts, model.cuts[1:])):
        codes[:, m] = _nearest(np.ascontiguousarray(rest[:, a:b]), model.codes[m])
        off += ((rest[:, a:b] - model.codes[m][codes[:, m]]) ** 2).sum(axis=1)
    squares = (model.centres**2).sum(axis=1)
    distance = 1 + squares - 2 * rows @ model.centres.T
    between = np.sqrt(np.maximum(squares[own, None] + squares - 2 * model.centres[own] @ model.centres.T, 1e-18))
    border = (distance - distance[np.arange(len(rows)), own][:, None]) / (2 * between)
    probed = border <= margin
    probed[np.arange(len(rows)), own] = True
    return own, codes, np.sqrt(off), [np.flatnonzero(p) for p in probed]


def _matrix(column):
    """Rows of an Arrow list column as doubles."""
    import numpy as np

    values = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(values), -1)


def _forest(label, i, j):
    """Least labels after joining positions pairwise."""
    import numpy as np

    while len(i):
        a, b = label[i], label[j]
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label[label] != label).any():
            label = label[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    return label


def _classes(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Each row's id and ``node``, a digest of its vector; NULL for a vector that links with nothing."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = ~F.exists(embedding, lambda x: x != 0)
    usable = F.col(embedding).isNotNull() & ~bad & ~zero
    # The text of a number tells any two numbers apart. Zeros of either sign are one.
    text = F.transform(embedding, lambda x: F.when(x == 0, F.lit(0).cast("double")).otherwise(x.cast("double")))
    node = F.when(F.coalesce(usable, F.lit(False)), F.sha2(text.cast("string"), 256))
    return vectors.select(F.col(vec_id).alias("vec_id"), node.alias("node"), F.col(embedding).alias("v"))


def _links(classes: DataFrame, threshold: float, margin: float | None) -> DataFrame:
    """(u, v, links): per class u the number of rows of other classes that link with it, in parts with
    v NULL; and links (u, v) that connect what is linked.
    """
    import numpy as np

    count = classes.count()
    # Digests are spread evenly, so those below a bound are a sample of about SAMPLE vectors, the same in every run.
    bound = min(1.0, SAMPLE / max(1, count)) * (1 << 32)
    sampled = F.conv(F.substring("node", 1, 8), 16, 10).cast("long") < F.lit(int(bound))
    sample = classes.filter(sampled).orderBy("node").select("v").toPandas()["v"]
    rows = np.stack([np.asarray(v) for v in sample])
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    model = fit(rows, min(MOST_LISTS, max(1, int(np.ceil(count**0.5)))))
    if margin is None:
        margin = fitted_margin(rows, model.centres, (2 - 2 * threshold) ** 0.5)
    block_rows = max(1, BLOCK * DIMENSIONS // max(DIMENSIONS, rows.shape[1]))
    small_batches(classes.sparkSession)

    def place(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            exact = _matrix(batch.column(2))
            unit = exact / np.abs(exact).max(axis=1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            own, codes, off, probed = _encode(unit, model, margin)
            columns = [
                pa.array(own, pa.int32()),
                pa.array([c.tobytes() for c in codes], pa.binary()),
                pa.array(off),
                pa.array([p.astype(np.int32) for p in probed], pa.list_(pa.int32())),
            ]
            yield pa.record_batch([*batch.columns, *columns], names=["node", "many", "v", "own", "codes", "off", "probes"])

    vector = classes.schema["v"].dataType.simpleString()
    kinds = f"node string, many long, v {vector}, own int, codes binary, off double, probes array<int>"
    placed = stash(classes.select("node", "many", "v").mapInArrow(place, kinds), "placed")
    members = placed.groupBy(F.col("own").alias("list")).agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("m"))
    asked = placed.select(F.explode("probes").alias("list")).groupBy("list").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("q"))
    # One row per list, of which there are MOST_LISTS at most.
    blocks = F.broadcast(asked.join(members, "list"))
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    common = ["node", "many", "v", "own"]
    held = placed.withColumn("list", F.col("own")).join(blocks, "list")
    held = held.select("list", *common, "codes", "off", "probes", block("m").alias("mb"), every("q").alias("qb"), F.lit(False).alias("query"))
    # The columns that only members need are NULL in queries.
    asks = placed.select(*common, F.explode("probes").alias("list")).join(blocks, "list")
    asks = asks.select(
        "list",
        *common,
        F.lit(None).cast("binary").alias("codes"),
        F.lit(None).cast("double").alias("off"),
        F.lit(None).cast("array<int>").alias("probes"),
        every("m").alias("mb"),
        block("q").alias("qb"),
        F.lit(True).alias("query"),
    )

    def compare(table):
        import numpy as np
        import pyarrow as pa

        queries = table.filter(table["query"])
        listed = table.filter(pa.compute.invert(table["query"]))
        out = [pa.field("u", pa.string()), pa.field("v", pa.string()), pa.field("links", pa.int64())]
        schema = pa.schema(out)
        if not queries.num_rows or not listed.num_rows:
            return schema.empty_table()
        number = listed["list"][0].as_py()
        q, x = _matrix(queries["v"]), _matrix(listed["v"])
        q /= np.abs(q).max(axis=1, keepdims=True)
        x /= np.abs(x).max(axis=1, keepdims=True)
        qn, xn = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
        codes = np.frombuffer(b"".join(listed["codes"].to_pylist()), np.uint8).reshape(len(x), -1)
        off = listed["off"].to_numpy()
        unit = q / qn[:, None]
        found = []
        for i in range(0, len(q), STRIP):
            part = unit[i : i + STRIP]
            near = np.repeat((part @ model.centres[number])[:, None], len(x), axis=1)
            for m, (a, b) in enumerate(zip(model.cuts, model.cuts[1:])):
                near += (part[:, a:b] @ model.codes[m].T)[:, codes[:, m]]
            one, other = np.nonzero(near >= threshold - off - 1e-9)
            found.append((one + i, other))
        qi, xi = (np.concatenate([f[side] for f in found]) for side in (0, 1))
        names = queries["node"].to_pylist() + listed["node"].to_pylist()
        places = {n: i for i, n in enumerate(dict.fromkeys(names))}
        at = np.array([places[n] for n in names])
        apart = at[qi] != at[len(q) + xi]
        qi, xi = qi[apart], xi[apart]
        close = [
            np.einsum("ij,ij->i", q[i], x[j]) / (qn[i] * xn[j]) >= threshold
            for i, j in ((qi[k : k + PAIRS], xi[k : k + PAIRS]) for k in range(0, len(qi), PAIRS))
        ]
        linked = np.concatenate(close) if close else np.zeros(0, bool)
        qi, xi = qi[linked], xi[linked]
        many_q, many_x = queries["many"].to_numpy(), listed["many"].to_numpy()
        links = np.zeros(len(places), np.int64)
        np.add.at(links, at[qi], many_x[xi])
        # A member that does not probe the query's list will not meet the query there, so it is told here.
        probes = np.zeros((len(x), len(model.centres)), bool)
        lists = listed["probes"].to_pylist()
        probes[np.repeat(np.arange(len(x)), [len(p) for p in lists]), np.concatenate(lists)] = True
        untold = ~probes[xi, queries["own"].to_numpy()[qi]]
        np.add.at(links, at[len(q) + xi[untold]], many_q[qi[untold]])
        label = _forest(np.arange(len(places)), at[qi], at[len(q) + xi])
        node = list(places)
        counted, child = np.flatnonzero(links), np.flatnonzero(label != np.arange(len(label)))
        us = [node[i] for i in counted] + [node[i] for i in child]
        vs = [None] * len(counted) + [node[i] for i in label[child]]
        values = [*links[counted].tolist(), *[0] * len(child)]
        return pa.table([pa.array(us, pa.string()), pa.array(vs, pa.string()), pa.array(values, pa.int64())], schema=schema)

    tiles = held.unionByName(asks).groupBy("list", "mb", "qb")
    return tiles.applyInArrow(compare, "u string, v string, links long")


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = THRESHOLD,
    margin: float | None = None,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows with a cosine of ``threshold`` or more that were found, ``component_id``
    is the least id that can be reached over links, the row's own included, and ``kept`` tells whether that is
    the row itself. Vectors that are NULL, zero, or hold a NULL or non-finite number link with nothing, and
    only vectors of equal length are compared. Without a ``margin`` one is fitted to each length. Equal vectors are one class, linked with each other
    and compared once, however many there are. A NULL id is nobody's component id unless all ids
    of a component are NULL. An empty table gives no rows.

    A list with many members or queries is cut into blocks, and pairs of blocks are compared by different tasks;
    what leaves a task is a number per vector and a spanning forest of the links, not the pairs.
    """
    rows = _classes(vectors, vec_id, embedding)
    classes = rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.count(F.lit(1)).alias("many"), F.min("vec_id").alias("least"), F.any_value("v").alias("v")
    )
    classes = stash(classes, "classes")
    sizes = sorted(r["d"] for r in classes.select(F.size("v").alias("d")).distinct().collect())
    parts = [_links(classes.filter(F.size("v") == d), threshold, margin) for d in sizes]
    found = None
    for part in parts:
        found = part if found is None else found.unionByName(part)
    spark = vectors.sparkSession
    found = spark.createDataFrame([], "u string, v string, links long") if found is None else stash(found, "links")
    roots = components(found.filter(F.col("v").isNotNull()).select("u", "v"))
    links = found.filter(F.col("v").isNull()).groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    placed = classes.select("node", "many", "least").join(roots, "node", "left").join(links, "node", "left")
    placed = stash(placed.withColumn("root", F.coalesce("root", "node")), "class-roots")
    reached = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = stash(
        lookup_join(placed, reached, "root").select(
            "node", (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
        ),
        "class-components",
    )
    joined = lookup_join(rows.select("vec_id", "node"), known, "node")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
