"""Near duplicates by SimHash and a Gray-order hierarchical index.

Fingerprints that differ in at most ``distance`` of 64 bits agree in all but ``distance`` of
``distance + 4`` blocks of bits. Each distinct fingerprint therefore goes once to every choice of
blocks that may agree, and all links are found among fingerprints that share the bits of a choice. Such a group
holds distinct values of the remaining bits only (22 of 64 at a distance of 2), so its size has a
bound whatever the data is like.

Within a group the fingerprints stand in the order of their Gray rank, in which neighbours differ in
few bits. Runs of eight become a node that keeps the bits all its members share, as a mask and a
pattern; runs of eight nodes become a node of the level above, and so on. The group is compared with itself
from the top: a pair of nodes carries the differences accumulated in the bits shared so far, adds
those of the bits that its level newly shares, and is dropped with everything below it as soon as
they exceed the distance. What is left at the bottom are the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from lamina.llm.common import ROW_KEY, row_key, small_batches, stash
from lamina.llm.components import components
from lamina.operators.joins import lookup_join

# Seed of the shingle hashes, and children of an index node.
SEED = 42
FANOUT = 8

# Node pairs compared at a time, and fingerprints gathered before their groups are searched.
PAIRS = 1 << 18
GATHERED = 1 << 16

# Shingles whose bits are unpacked at a time.
UNPACKED = 1 << 14


def fingerprint_of(data: bytes | None, shingle: int = 3) -> int:
    """SimHash of a text: the bits set in over half the hashes of its word shingles, repeats included.

    A-Z are lower-cased and words stand between ASCII blanks. A text of fewer words than a shingle is
    one shingle; one without words has fingerprint zero, as has NULL.
    """
    import numpy as np
    from xxhash import xxh64_intdigest

    words = data.lower().split() if data else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(line, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = (ends - sizes)[: len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(begins, stops)], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), UNPACKED):
        octets = hashes[i : i + UNPACKED].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """The key columns and the fingerprint of each row, as a signed long of the same bits."""
    small_batches(docs.sparkSession)

    def each(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint_of(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([*batch.columns[:-1], pa.array(prints)], names=[*keys, "fp"])

    chosen = docs.select(*keys, F.col(text).alias("_lamina_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(each, f"{kinds}, fp long")


def gray_rank(code: Column) -> Column:
    """Position of a 64-bit word in the reflected Gray order, as a signed long."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code


def _hex(code: str) -> Column:
    return F.lower(F.lpad(F.hex(code), 16, "0"))


def _masks(distance: int) -> list[int]:
    """Masks of the block choices, as signed longs."""
    blocks = distance + 4
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    chosen = (sum(c) for c in combinations(parts, blocks - distance))
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def _levels(prints, starts) -> list[tuple]:
    """Index of groups beginning at ``starts``: per level patterns, masks and first children; the last level has a node a group."""
    import numpy as np

    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    pattern, mask = prints, np.full(len(prints), full)
    levels = [(pattern, mask, None)]
    sizes = np.diff(np.append(starts, len(prints)))
    while sizes.max(initial=0) > 1:
        above = -(-sizes // FANOUT)
        group = np.repeat(np.arange(len(sizes)), above)
        nth = np.arange(len(group)) - np.repeat(np.cumsum(above) - above, above)
        first = (np.cumsum(sizes) - sizes)[group] + nth * FANOUT
        every, some = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern, first)
        mask = np.bitwise_and.reduceat(mask, first) & ~(every ^ some)
        pattern = every & mask
        levels.append((pattern, mask, np.append(first, sizes.sum())))
        sizes = above
    return levels


def _close_pairs(prints, starts, distance: int) -> Iterator[tuple]:
    """Positions (i, j), i < j, of fingerprints of one group that differ in at most ``distance`` bits."""
    import numpy as np

    levels = _levels(prints, starts)
    roots = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, roots, roots, np.zeros(len(roots), np.int64))]
    while stack:
        level, left, right, differ = stack.pop()
        if len(left) > PAIRS:
            half = len(left) // 2
            stack += [(level, left[k], right[k], differ[k]) for k in (slice(half), slice(half, None))]
            continue
        if level == 0:
            apart = left < right
            yield left[apart], right[apart]
            continue
        _, mask, first = levels[level]
        pattern, below, _ = levels[level - 1]
        many, others = first[left + 1] - first[left], first[right + 1] - first[right]
        times = many * others
        pair = np.repeat(np.arange(len(left)), times)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        i = first[left][pair] + nth // others[pair]
        j = first[right][pair] + nth % others[pair]
        known = mask[left] & mask[right]
        new = below[i] & below[j] & ~known[pair]
        total = differ[pair] + np.bitwise_count((pattern[i] ^ pattern[j]) & new)
        near = (total <= distance) & (i <= j)
        if near.any():
            stack.append((level - 1, i[near], j[near], total[near]))


def _joined(label, i, j):
    """Least-member labels after joining the positions i and j pairwise."""
    import numpy as np

    while len(i):
        a, b = label[i], label[j]
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


def close_links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints of ``fp`` within ``distance`` bits.

    A dense group yields a spanning forest of its links, not every pair; what is connected by links
    is connected by the forest.
    """
    masks = _masks(distance)

    def search(batches):
        import numpy as np
        import pyarrow as pa

        def links(choice, shared, prints):
            fresh = np.append(True, (choice[1:] != choice[:-1]) | (shared[1:] != shared[:-1]))
            starts = np.flatnonzero(fresh)
            sizes = np.diff(np.append(starts, len(prints)))
            kept = np.repeat(sizes > 1, sizes)
            prints, sizes = prints[kept], sizes[sizes > 1]
            if not len(prints):
                return
            label = np.arange(len(prints))
            for i, j in _close_pairs(prints, np.cumsum(sizes) - sizes, distance):
                label = _joined(label, i, j)
            child = np.flatnonzero(label != np.arange(len(label)))
            columns = [pa.array(prints[x].view(np.int64)) for x in (child, label[child])]
            yield pa.record_batch(columns, names=["u", "v"])

        held: list[tuple] = []
        gathered = 0
        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            gathered += batch.num_rows
            if gathered < GATHERED:
                continue
            choice, shared, prints = (np.concatenate(c) for c in zip(*held))
            # The last group may go on in the next batch.
            last = np.flatnonzero((choice != choice[-1]) | (shared != shared[-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield from links(choice[:cut], shared[:cut], prints[:cut].view(np.uint64))
            held = [(choice[cut:], shared[cut:], prints[cut:])]
            gathered = len(prints) - cut
        if gathered:
            choice, shared, prints = (np.concatenate(c) for c in zip(*held))
            yield from links(choice, shared, prints.view(np.uint64))

    choices = F.array(*[F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("shared")) for n, m in enumerate(masks)])
    entries = prints.select("fp", F.explode(choices).alias("e")).select("e.choice", "e.shared", "fp")
    dealt = entries.repartition("choice", "shared").sortWithinPartitions("choice", "shared", gray_rank(F.col("fp")))
    return dealt.mapInArrow(search, "u long, v long")


def simhash_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    distance: int = 2,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keys``, ``fingerprint``, ``component_id`` and ``component_root``.

    ``component_id`` is the least id that can be reached over links of at most ``distance`` differing
    bits, the row's own included. Equal fingerprints are linked, so copies share a component however many there
    are: fingerprints are made distinct before any search. NULL ids take part but are never a
    component's id unless all its ids are NULL; ``component_root`` is the least fingerprint of the component,
    as a signed number, and tells components apart in any case. NULL, empty and blank texts have fingerprint zero.
    An empty table gives no rows.
    """
    columns = list(dict.fromkeys([doc_id, *keys]))
    rows = stash(fingerprints(docs, columns, text, shingle), "prints")
    least = stash(rows.groupBy("fp").agg(F.min(doc_id).alias("least")), "distinct-prints")
    roots = components(close_links(least.select("fp"), distance))
    linked = roots.join(least.withColumnRenamed("fp", "node"), "node").select("node", "root", "least")
    reached = linked.groupBy("root").agg(F.min("least").alias("reached"))
    linked = lookup_join(linked.withColumnRenamed("node", "fp").drop("least"), reached, "root", "inner")
    grouped = lookup_join(least, linked, "fp").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("reached", "least").alias("component_id")
    )
    # Stored, so that the join below reads both sides from shuffles and can be split where a fingerprint is hot.
    groups = stash(grouped, "groups")
    return lookup_join(rows, groups, "fp").select(
        *columns, _hex("fp").alias("fingerprint"), "component_id", _hex("root").alias("component_root")
    )


def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the least id stays.

    All columns are kept. Where several rows carry that id, one of them stays; where all ids of a component
    are NULL, one row stays.
    """
    named = docs.withColumns(row_key(doc_id, text))
    groups = simhash_groups(named, doc_id, text, shingle, distance, keys=ROW_KEY)
    # Within a component the least id, and of rows with that id the least text hash.
    first = F.min(F.struct(F.col(doc_id).isNull().alias("n"), *ROW_KEY)).alias("first")
    leaders = groups.groupBy("component_root").agg(first)
    stay = leaders.select(*[F.col(f"first.{c}").alias(c) for c in ROW_KEY])
    many = groups.groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("_lamina_copies"))
    stay = stash(lookup_join(stay, many, list(ROW_KEY), "inner"), "kept-rows")
    joined = lookup_join(named, stay, list(ROW_KEY), "inner")
    once = joined.filter(F.col("_lamina_copies") == 1)
    repeated = joined.filter(F.col("_lamina_copies") > 1).dropDuplicates(list(ROW_KEY))
    return once.unionByName(repeated).select(*docs.columns)
