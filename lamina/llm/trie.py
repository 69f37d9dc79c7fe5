"""Prefix trie of rebuilt conversations, by composable fingerprints.

A sequence of turns stands for the map x -> x * B^n + H modulo a prime; putting sequences together is putting their maps
together, which is associative. So the product of a conversation is made of those of its pieces, wherever
they are stored, and the fingerprint of every prefix of a rebuilt conversation follows from its base's head and
its own turns: a rebuilt text is never made. With G the running product of a conversation's own turns and h turns
left out, the first m that remain have the product G(h + m) - G(h) * B^m; behind a head with the product E
the prefix has E * B^m + G(h + m) - G(h) * B^m.

Equal fingerprints are not taken on trust. Turns with equal hashes are compared with a stored turn that
stands for them, text by text, and all prefixes of a group must agree in the parent's fingerprint and in their
last turn; by induction over the depth they are equal then. If anything differs, all is done again with another seed.

Turns are sorted across tasks, so a conversation may be spread over many. A node's sums over its subtree are sums over its
members: every node belongs to its smallest member, the nodes of a member are the end of its path, and a
running sum along that path is what the member gives to each of its ancestors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lamina.llm.common import small_batches, stash
from lamina.operators.joins import lookup_join

# Conversations that share a base, and most turns of a base's head.
BLOCK = 20
HEADS = 4

# The prime of the products, of which there are two with bases of their own.
PRIME = (1 << 61) - 1

# Nodes of a path that are summed in one window, and ids in one piece of a list.
RUN = 4096


def _bases(seed: int, prime: int) -> tuple[int, int]:
    import hashlib

    digest = hashlib.blake2b(b"bases", digest_size=16, salt=seed.to_bytes(8, "big")).digest()
    return tuple(2 + int.from_bytes(digest[i : i + 8], "big") % (prime - 2) for i in (0, 8))


def _stored_turns(turns: DataFrame, seed: int, prime: int) -> DataFrame:
    """The turns sorted by conversation and turn, in runs: (conv_id, part, i, role, text, words, t1, t2, g1, g2).

    ``part`` is the task that wrote a run, ``i`` a turn's place in it; ``t`` are a turn's hashes and ``g`` the run's products up
    to the turn.
    """
    start = F.substring("text", 1, 64)
    ordered = turns.repartitionByRange(
        "conv_id", F.col("turn").asc_nulls_first(), "role", start
    ).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    bases = _bases(seed, prime)

    def run(batches):
        import hashlib
        import re

        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        salt = seed.to_bytes(8, "big")
        words = re.compile(rb"[^\x20\x09-\x0D]+")
        names = ["conv_id", "part", "i", "role", "text", "words", "t1", "t2", "g1", "g2"]
        last, i, g1, g2 = None, 0, 0, 0
        for batch in batches:
            rows = []
            columns = [batch.column(0).to_pylist(), *(batch.column(c).cast(pa.binary()).to_pylist() for c in (1, 2))]
            for conv, role, text in zip(*columns):
                if conv != last:
                    last, i, g1, g2 = conv, 0, 0, 0
                digest = hashlib.blake2b(b"%d:%s%s" % (len(role), role, text), digest_size=16, salt=salt).digest()
                t1, t2 = (int.from_bytes(digest[k : k + 8], "big") % prime for k in (0, 8))
                g1, g2 = (g1 * bases[0] + t1) % prime, (g2 * bases[1] + t2) % prime
                rows.append((i, sum(1 for _ in words.finditer(text)), t1, t2, g1, g2))
                i += 1
            own = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 6
            whole = [batch.column(0), pa.array([part] * len(rows), pa.int64()), own[0], batch.column(1), batch.column(2), *own[1:]]
            yield pa.record_batch(whole, names=names)

    kinds = "conv_id long, part long, i long, role string, text string, words long, t1 long, t2 long, g1 long, g2 long"
    return stash(ordered.select("conv_id", "role", "text").mapInArrow(run, kinds), "turns")


def _run_starts(turns: DataFrame, seed: int, prime: int) -> DataFrame:
    """(conv_id, part, offset, s1, s2): number and product of the turns before each run that goes on from another.

    A task's first conversation alone can go on, so there are as many rows as tasks at most, also of one conversation.
    """
    runs = turns.groupBy("conv_id", "part").agg(F.max(F.struct("i", "g1", "g2")).alias("last"))
    many = runs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("runs")).filter("runs > 1").select("conv_id")
    cut = runs.join(many, "conv_id").select("conv_id", "part", "last.*")
    bases = _bases(seed, prime)

    def add(table):
        import pyarrow as pa

        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        out, offset, s1, s2 = [], 0, 0, 0
        for r in rows:
            out.append((r["conv_id"], r["part"], offset, s1, s2))
            n = r["i"] + 1
            offset += n
            s1 = (s1 * pow(bases[0], n, prime) + r["g1"]) % prime
            s2 = (s2 * pow(bases[1], n, prime) + r["g2"]) % prime
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names=["conv_id", "part", "offset", "s1", "s2"])

    return cut.groupBy("conv_id").applyInArrow(add, "conv_id long, part long, offset long, s1 long, s2 long")


def _numbered(turns: DataFrame, seed: int, prime: int) -> DataFrame:
    """(conv_id, pos, words, t1, t2, g1, g2): every turn's place in its conversation and the product up to it."""
    starts = stash(_run_starts(turns, seed, prime), "run-starts")
    # One row per task at most.
    joined = turns.select("conv_id", "part", "i", "words", "t1", "t2", "g1", "g2").join(
        F.broadcast(starts), ["conv_id", "part"], "left"
    )
    bases = _bases(seed, prime)

    def shift(batches):
        import pyarrow as pa

        for batch in batches:
            c = [batch.column(k).to_pylist() for k in range(9)]
            for k, (offset, i) in enumerate(zip(c[6], c[1])):
                if offset is not None:
                    c[1][k] = offset + i
                    for g, s, base in ((4, 7, bases[0]), (5, 8, bases[1])):
                        c[g][k] = (c[s][k] * pow(base, i + 1, prime) + c[g][k]) % prime
            yield pa.record_batch([pa.array(x, pa.int64()) for x in c[:6]], names=["conv_id", "pos", "t1", "t2", "g1", "g2"]).append_column(
                "words", batch.column(9)
            )

    chosen = joined.select("conv_id", "i", "t1", "t2", "g1", "g2", "offset", "s1", "s2", "words")
    kinds = "conv_id long, pos long, t1 long, t2 long, g1 long, g2 long, words long"
    return stash(chosen.mapInArrow(shift, kinds), "numbered")


def _entries(numbered: DataFrame, left_out: Column, block: int, seed: int, prime: int) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations (conv_id, size) and their prefixes (conv_id, depth, words, t, f, p: fingerprints of prefix and parent)."""
    convs = numbered.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"), *[F.max(F.when(F.col("pos") == k, F.struct("g1", "g2"))).alias(f"g{k}") for k in range(HEADS - 1)]
    )
    convs = stash(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).withColumn("h", left_out.cast("long")), "conversations")
    based = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), *[F.col(f"g{k}").alias(f"e{k}") for k in range(HEADS - 1)])
    # A base has few conversations, and every conversation is one row.
    plans = convs.join(based, "base", "left")
    head = F.least("h", F.coalesce("base_n", F.lit(0)))
    zero = F.struct(F.lit(0).cast("long").alias("g1"), F.lit(0).cast("long").alias("g2"))

    def product(prefix: str, many: Column) -> Column:
        """The product of the first ``many`` turns, which are fewer than HEADS."""
        found = F.when(many == 0, zero)
        for k in range(HEADS - 1):
            found = found.when(many == k + 1, F.col(f"{prefix}{k}"))
        return found

    plans = plans.select(
        "conv_id",
        "base",
        "h",
        head.alias("head"),
        (head + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size"),
        product("e", head).alias("e"),
        product("g", F.least("h", "n")).alias("own"),
    )
    plans = stash(plans, "plans")
    # Head turns, by their base: at most HEADS - 1 of them, and a block of conversations.
    heads = numbered.filter(F.col("pos") < HEADS - 1).withColumnRenamed("conv_id", "base").join(
        plans.filter("head > 0").select("conv_id", "base", "head"), "base"
    )
    heads = heads.filter("pos < head").select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "words", "t1", "t2", F.col("g1").alias("f1"), F.col("g2").alias("f2")
    )
    tails = lookup_join(numbered, plans.select("conv_id", "h", "head", "e", "own"), "conv_id", "inner").filter("pos >= h")
    tails = tails.select(
        "conv_id", "words", "t1", "t2", "g1", "g2", (F.col("pos") + 1 - F.col("h")).alias("m"), "head", "e.g1", "e.g2", "own.g1", "own.g2"
    ).toDF("conv_id", "words", "t1", "t2", "g1", "g2", "m", "head", "e1", "e2", "o1", "o2")
    bases = _bases(seed, prime)

    def combine(batches):
        import pyarrow as pa

        powers: dict[int, tuple[int, int]] = {}
        for batch in batches:
            c = [batch.column(k).to_pylist() for k in range(12)]
            f1, f2 = [], []
            for m, g1, g2, e1, e2, o1, o2 in zip(c[6], c[4], c[5], *c[8:12]):
                if m not in powers:
                    if len(powers) > 1 << 16:
                        powers.clear()
                    powers[m] = pow(bases[0], m, prime), pow(bases[1], m, prime)
                b1, b2 = powers[m]
                f1.append((g1 + (e1 - o1) * b1) % prime)
                f2.append((g2 + (e2 - o2) * b2) % prime)
            depth = [m + h for m, h in zip(c[6], c[7])]
            own = [pa.array(x, pa.int64()) for x in (depth, c[1], c[2], c[3], f1, f2)]
            yield pa.record_batch([batch.column(0), *own], names=["conv_id", "depth", "words", "t1", "t2", "f1", "f2"])

    kinds = "conv_id long, depth long, words long, t1 long, t2 long, f1 long, f2 long"
    whole = heads.unionByName(tails.mapInArrow(combine, kinds))
    inverse = [pow(b, -1, prime) for b in bases]

    def parents(batches):
        import pyarrow as pa

        for batch in batches:
            t1, t2, f1, f2 = (batch.column(c).to_pylist() for c in ("t1", "t2", "f1", "f2"))
            p1 = [(f - t) * inverse[0] % prime for f, t in zip(f1, t1)]
            p2 = [(f - t) * inverse[1] % prime for f, t in zip(f2, t2)]
            yield pa.record_batch([*batch.columns, pa.array(p1, pa.int64()), pa.array(p2, pa.int64())], names=[*batch.schema.names, "p1", "p2"])

    nodes = whole.mapInArrow(parents, f"{kinds}, p1 long, p2 long")
    nothing = {c: F.lit(0).cast("long") for c in ("depth", "words", "t1", "t2", "f1", "f2", "p1", "p2")}
    roots = plans.select("conv_id").withColumns(nothing)
    return plans.select("conv_id", "size"), stash(nodes.unionByName(roots), "prefixes")


def _turns_agree(turns: DataFrame) -> bool:
    """Whether turns with equal hashes are equal, each compared with a stored turn that stands for them."""
    hashes = ["t1", "t2"]
    place = F.struct("conv_id", "part", "i")
    shared = turns.groupBy(*hashes).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1")
    met = lookup_join(turns.select(*hashes, "role", "text", place.alias("place")), shared.drop("n"), hashes, "inner")
    met = stash(met, "shared-turns")
    first = met.filter(F.col("place") == F.col("first")).select(*hashes, F.col("role").alias("_role"), F.col("text").alias("_text"))
    pairs = lookup_join(met, first, hashes, "inner")
    return pairs.filter((F.col("role") != F.col("_role")) | (F.col("text") != F.col("_text"))).isEmpty()


def _ends(last: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends): SHA-256 of the ids of each node, in order and between commas.

    Ids are sorted across tasks and joined in pieces; a node's pieces are then read one after the other, so no task holds a
    list, however many conversations end alike.
    """
    node = ["depth", "f1", "f2"]

    def pieces(batches):
        import pyarrow as pa

        def handed(rows):
            fields = ["depth", "f1", "f2", "first", "ids"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])], names=fields)

        own, ids, rows = None, [], []
        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != own or len(ids) >= RUN:
                    if ids:
                        rows.append((*own, ids[0], ",".join(map(str, ids))))
                    own, ids = key, []
                ids.append(conv)
            if len(rows) >= 1024:
                yield handed(rows)
                rows = []
        if ids:
            rows.append((*own, ids[0], ",".join(map(str, ids))))
        if rows:
            yield handed(rows)

    def digests(batches):
        import hashlib

        import pyarrow as pa

        def handed(rows):
            fields = ["depth", "f1", "f2", "ends"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], names=fields)

        own, digest, rows = None, None, []
        for batch in batches:
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if key != own:
                    if own:
                        rows.append((*own, digest.hexdigest()))
                    own, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if len(rows) >= 1024:
                yield handed(rows)
                rows = []
        if own:
            rows.append((*own, digest.hexdigest()))
        if rows:
            yield handed(rows)

    spread = last.select(*node, "conv_id").repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")
    kinds = "depth long, f1 long, f2 long"
    joined = spread.mapInArrow(pieces, f"{kinds}, first long, ids string")
    joined = joined.repartition(*node).sortWithinPartitions(*node, "first")
    return joined.mapInArrow(digests, f"{kinds}, ends string")


def prefix_trie(
    conversations: DataFrame,
    left_out: Column,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block: int = BLOCK,
    primes: Sequence[int] = (PRIME,),
) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A conversation is rebuilt as the first ``left_out`` turns (an expression over ``conv_id``, from 0 to 3) of the conversation
    whose id is the multiple of ``block`` towards 0, and its own turns after as many. Turns are in the order of ``turn``, NULL
    first, equal ones by role and text; NULL roles and texts are empty and repeated rows are turns of their own. Rows
    without a conversation are left out. A node is a prefix that rebuilt conversations share, named after the smallest of them;
    an empty table has no nodes, not even the root. ``primes`` are taken one after the other until nothing collides.
    """
    small_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).filter(F.col("conv_id").isNotNull())
    node = ["depth", "f1", "f2"]
    seed = 0
    while True:
        prime = primes[min(seed, len(primes) - 1)]
        turns = _stored_turns(rows, seed, prime)
        sizes, prefixes = _entries(_numbered(turns, seed, prime), left_out, block, seed, prime)
        told = ["p1", "p2", "t1", "t2"]
        nodes = prefixes.groupBy(*node).agg(
            F.min("conv_id").alias("owner"),
            F.count(F.lit(1)).alias("n_convs"),
            F.max("words").alias("words"),
            *[F.max(c).alias(c) for c in told],
            *[(F.min(c) != F.max(c)).alias(f"_{c}") for c in told],
        )
        nodes = stash(nodes, "nodes")
        clash = nodes.filter(F.col("_p1") | F.col("_p2") | F.col("_t1") | F.col("_t2"))
        if clash.isEmpty() and _turns_agree(turns):
            break
        seed += 1
    up = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")]
    children = nodes.filter("depth > 0").select(*up).groupBy(*node).agg(F.count(F.lit(1)).alias("n_children"))
    value = ((F.col("n_convs") - 1) * F.col("words")).alias("value")
    nodes = nodes.select(*node, "p1", "p2", "owner", "n_convs", value).join(children, node, "left")
    nodes = stash(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    # What each conversation owns in all, and which of its nodes is a leaf.
    owned = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.sum("value").alias("saved"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf")
    )
    given = lookup_join(prefixes.select("conv_id", *node), stash(owned, "owned"), "conv_id", "inner")
    sums = given.groupBy(*node).agg(F.sum("saved").alias("members_saved"), F.sum("leaf").alias("n_leaves"))
    # The sum from each node to the end of its owner's path, run by run, so that a long path is summed by many tasks.
    run = F.floor(F.col("depth") / RUN).alias("run")
    totals = nodes.groupBy("owner", run).agg(F.sum("value").alias("total"))
    behind = Window.partitionBy("owner").orderBy(F.desc("run"))
    totals = totals.withColumn("after", F.sum("total").over(behind) - F.col("total"))
    totals = totals.withColumn("whole", F.sum("total").over(Window.partitionBy("owner"))).drop("total")
    inside = Window.partitionBy("owner", "run").orderBy(F.desc("depth"))
    chains = nodes.withColumn("run", run).withColumn("within", F.sum("value").over(inside)).join(totals, ["owner", "run"])
    last = sizes.withColumnRenamed("size", "depth")
    ended = lookup_join(prefixes.select("conv_id", *node), last, ["conv_id", "depth"], "inner")
    found = chains.join(sums, node).join(_ends(ended), node, "left")
    parents = nodes.select("depth", "f1", "f2", F.col("owner").alias("parent_conv_id"))
    found = found.withColumns({"_depth": F.col("depth"), "depth": F.col("depth") - 1, "f1": F.col("p1"), "f2": F.col("p2")})
    joined = lookup_join(found, parents, node, "left")
    return joined.select(
        F.col("owner").alias("conv_id"),
        F.col("_depth").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        # Members other than the owner give all that they own, the owner what it owns from here on.
        (F.col("members_saved") - F.col("whole") + F.col("within") + F.col("after")).alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
