"""Spelling variants: words that differ by one letter, and the frequent word that each rare one stands for.

Two words are one edit apart only if their letter counts are at a squared distance of 1 (a letter more or
less) or 2 (another letter). Blocks of words are compared by the Gram matrix of their letter counts, which is one
NumPy product; pairs at a distance of two at most are verified letter by letter.

A block holds words of a length and of the next one that share a half: an edit leaves either the first or the
last half of the shorter length as it is, so every pair meets in a block of first halves or of last halves, and one
that meets in both counts in the first. Blocks that are too large for a task are cut into tiles, and small ones are
packed into one product.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from lamina.llm.common import small_batches, stash, stash_seen
from lamina.operators.joins import lookup_join

# Shortest word, fewest occurrences, how many times as frequent a form has to be, and one in so many
# runs of letters loses a letter.
SHORTEST = 7
LEAST = 2
RATIO = 10
MISSPELT = 31

# Bytes of distinct words that a counting task gathers, and of a text that is cut into words at a time.
GATHERED = 32 << 20
PIECE = 1 << 20

# Words of a tile on either side, those of longer words count in proportion to WIDTH; rows of packed small tiles;
# rows of a Gram matrix at a time; letters of pairs that are verified at a time.
TILE = 4096
WIDTH = 1024
PACKED = 256
STRIP = 512
VERIFIED = 1 << 24


def _pieces(line: bytes) -> Iterator[bytes]:
    """The line in pieces of about ``PIECE`` bytes that end where a run of letters ends."""
    import re

    gap = re.compile(rb"[^a-z\xc0-\xff]").search
    begin = 0
    while len(line) - begin > PIECE:
        found = gap(line, begin + PIECE)
        if not found:
            break
        yield line[begin : found.start()]
        begin = found.start()
    yield line[begin:]


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """(word, n): runs of letters A-Z, a-z and U+00C0 to U+00FF of ``shortest`` letters or more in all texts.

    A-Z are lower-cased. Where 31 divides the crc32 of id and run the run loses one letter, as the contract says, before its
    length counts. A NULL id is the empty text there, a NULL text has no runs.
    """

    def count(batches):
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa

        # A match of the shortest length or more is a whole run, as it begins at the run's first letter.
        runs = re.compile(rb"[a-z\xc0-\xff]{%d,}" % shortest).findall
        counts: dict[bytes, int] = {}
        held = 0

        def handed():
            words, numbers = list(counts), list(counts.values())
            for i in range(0, len(words), 1 << 16):
                part = pa.array([w.decode("latin-1") for w in words[i : i + (1 << 16)]], pa.string())
                yield pa.record_batch([part, pa.array(numbers[i : i + (1 << 16)], pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not value:
                    continue
                prefix = f"{'' if doc is None else doc}:".encode()
                # What is beyond U+00FF becomes a question mark, which is no letter.
                for piece in _pieces(value.encode("latin-1", "replace").lower()):
                    for run, n in Counter(runs(piece)).items():
                        h = zlib.crc32(prefix + (run if run.isascii() else run.decode("latin-1").encode()))
                        if h % MISSPELT == 0:
                            k = h % len(run)
                            run = run[:k] + run[k + 1 :]
                            if len(run) < shortest:
                                continue
                        if run in counts:
                            counts[run] += n
                        else:
                            counts[run] = n
                            held += len(run) + 100
                    if held > GATHERED:
                        yield from handed()
                        counts, held = {}, 0
        yield from handed()

    small_batches(docs.sparkSession)
    parts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


class Tiles:
    """Rows of several tiles: words, counts, and per row the shorter length, the side of the shared half, and the block."""

    def __init__(self, words, n, low, first, own, mixed, tile):
        import numpy as np

        self.words, self.n, self.low, self.first, self.own, self.mixed, self.tile = words, n, low, first, own, mixed, tile
        self.size = np.array([len(w) for w in words])
        flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.width = int(self.size.max())
        self.at = np.arange(self.width)
        self.letters = np.zeros((len(words), self.width), np.uint8)
        self.letters[self.at < self.size[:, None]] = flat
        used, code = np.unique(flat, return_inverse=True)
        cell = np.repeat(np.arange(len(words)), self.size) * len(used) + code
        # Squares of the counts have to be exact.
        kind = np.float32 if self.width < 4096 else np.float64
        self.counts = np.bincount(cell, minlength=len(words) * len(used)).reshape(len(words), -1).astype(kind)

    def candidates(self):
        """Pairs of rows whose letter counts are at a squared distance of 1 or 2."""
        import numpy as np

        squares = (self.counts**2).sum(axis=1)
        for i in range(0, len(squares), STRIP):
            gram = self.counts[i : i + STRIP] @ self.counts[i:].T
            gram *= -2
            gram += squares[i : i + STRIP, None]
            gram += squares[i:]
            a, b = np.nonzero(gram <= 2)
            above = a < b
            yield a[above] + i, b[above] + i

    def met_here(self, a, b):
        """The pairs that are to be judged in their tile: of one block, not both longer, of the tile's two parts."""
        same = (self.tile[a] == self.tile[b]) & (self.low[a] == self.low[b]) & (self.first[a] == self.first[b])
        same &= (self.size[a] == self.low[a]) | (self.size[b] == self.low[b])
        return same & (self.mixed[a] == (self.own[a] != self.own[b]))

    def one_edit(self, a, b):
        """Which pairs are one edit apart and share the half that their block is named after."""
        import numpy as np

        swap = self.size[a] > self.size[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        x, y, short = self.letters[a], self.letters[b], self.size[a][:, None]
        equal = x == y
        replaced = (~equal).sum(axis=1) == 1
        # The letters before the first difference, then the longer word's letters one place on.
        begin = np.where(equal.all(axis=1), self.width, (~equal).argmax(axis=1))[:, None]
        moved = np.zeros_like(equal)
        moved[:, :-1] = x[:, :-1] == y[:, 1:]
        inserted = (moved | (self.at < begin) | (self.at >= short)).all(axis=1)
        half = (self.low[a] // 2)[:, None]
        first = (equal | (self.at >= half)).all(axis=1)
        ends = [np.take_along_axis(m, np.maximum(self.size[r][:, None] - 1 - self.at, 0), axis=1) for m, r in ((x, a), (y, b))]
        last = ((ends[0] == ends[1]) | (self.at >= half)).all(axis=1)
        edit = np.where(self.size[a] == self.size[b], replaced, inserted)
        return edit & np.where(self.first[a], first, last & ~first)

    def near(self):
        """Per row with a near word in its tile: row, number of near words, count and row of the most frequent."""
        import numpy as np

        found = []
        step = max(1, VERIFIED // self.width)
        for a, b in self.candidates():
            kept = self.met_here(a, b)
            a, b = a[kept], b[kept]
            for i in range(0, len(a), step):
                one = self.one_edit(a[i : i + step], b[i : i + step])
                found.append((a[i : i + step][one], b[i : i + step][one]))
        a, b = (np.concatenate([f[s] for f in found]) for s in (0, 1)) if found else (np.zeros(0, int), np.zeros(0, int))
        rank = np.empty(len(self.words), np.int64)
        rank[sorted(range(len(self.words)), key=self.words.__getitem__)] = np.arange(len(self.words))
        row, other = np.concatenate([a, b]), np.concatenate([b, a])
        order = np.lexsort((rank[other], -self.n[other], row))
        row, other = row[order], other[order]
        rows, first, many = np.unique(row, return_index=True, return_counts=True)
        return rows, many, other[first]


def _near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): per tile the number of a word's near words, and (-count, word) of the most frequent."""
    length = F.length("word")
    low = F.explode(F.array(length, length - 1))
    placed = words.select("word", "n", low.alias("low")).withColumn("first", F.explode(F.array(F.lit(True), F.lit(False))))
    half = F.expr("CASE WHEN first THEN substring(word, 1, low div 2) ELSE right(word, low div 2) END")
    placed = placed.withColumn("key", F.xxhash64("low", "first", half))
    many = F.ceil(F.count(F.lit(1)) * F.greatest(F.lit(1.0), F.max("low") / WIDTH) / TILE)
    hot = placed.groupBy("key").agg(many.cast("int").alias("m")).filter("m > 1")
    dealt = lookup_join(placed, hot, "key").withColumn("m", F.coalesce("m", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), F.col("m")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    tile = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = dealt.select("word", "n", "low", "first", "own", (F.col("own") != F.col("other")).alias("mixed"), tile.alias("tile"))
    # In a tile of two blocks, rows of both have other = the other one; a block's own tile is not mixed.
    ordered = dealt.repartition("tile").sortWithinPartitions("low", "tile")

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        def judged(table):
            columns = [table.column(c).to_numpy() for c in ("n", "low", "first", "own", "mixed", "tile")]
            tiles = Tiles(table.column("word").to_pylist(), *columns)
            rows, many, best = tiles.near()
            names = tiles.words
            return pa.record_batch(
                [
                    pa.array([names[i] for i in rows], pa.string()),
                    pa.array(many, pa.int64()),
                    pa.array(-tiles.n[best], pa.int64()),
                    pa.array([names[i] for i in best], pa.string()),
                ],
                names=["word", "n_near", "negative", "other"],
            )

        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            # Rows come in the order of their length, so those of long words are packed by their letters.
            packed = max(1, min(PACKED, (1 << 22) // max(1, rest.column("low")[-1].as_py())))
            if rest.num_rows < packed:
                continue
            tile = rest.column("tile").to_numpy()
            begins = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
            # Whole tiles, packed; the last may go on in the next batch.
            start = 0
            for end in begins[1:].tolist():
                if end - start >= packed:
                    yield judged(rest.slice(start, end - start).combine_chunks())
                    start = end
            if start < begins[-1]:
                yield judged(rest.slice(start, begins[-1] - start).combine_chunks())
            rest = rest.slice(begins[-1])
        if rest is not None and rest.num_rows:
            yield judged(rest.combine_chunks())

    return ordered.mapInArrow(compare, "word string, n_near long, negative long, other string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of each word with a form end; the steps known are doubled in each round.

    A form is ``RATIO`` times as frequent as its word, so chains are as long as the logarithm of the largest count at most.
    """
    steps = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = lookup_join(steps, onward, "root")
        steps, seen = stash_seen(
            joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")),
            "spelling-roots",
            moved=F.count_if("_moved"),
        )
        steps = steps.drop("_moved")
        if not seen["moved"]:
            return steps


def spelling_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    least: int = LEAST,
    ratio: int = RATIO,
) -> DataFrame:
    """One row per word of all texts: ``word, form, root, n, n_near, form_n``.

    Words are as ``count_words`` gives them, if they occur ``least`` times. ``n_near`` is the number of words at exactly one edit, ``form``
    the most frequent of these (ties: the least in code-point order) if it is ``ratio`` times as
    frequent as the word, ``root`` the end of the chain of forms, the word itself where there is none. Rows count as they come, repeated ones and those without an id
    included; NULL and empty texts hold no word, and an empty table gives no rows.
    """
    if shortest < 4:
        raise ValueError("halves of words under four letters do not tell words apart")
    words = stash(count_words(docs, doc_id, text, shortest).filter(F.col("n") >= least), "words")
    near = _near_words(words).select(
        "word", F.lit(None).cast("long").alias("n"), "n_near", F.struct("negative", "other").alias("best")
    )
    alone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<negative:bigint,other:string>").alias("best"))
    whole = alone.unionByName(near).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    better = -F.col("best.negative") >= ratio * F.col("n")
    whole = stash(
        whole.select(
            "word",
            F.when(better, F.col("best.other")).alias("form"),
            "n",
            "n_near",
            F.when(better, -F.col("best.negative")).alias("form_n"),
        ),
        "spelling",
    )
    roots = _roots(whole.filter(F.col("form").isNotNull()).select("word", "form"))
    joined = lookup_join(whole, roots, "word")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
