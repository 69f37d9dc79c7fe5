"""Language-model scores: the probability of a text over all its segmentations into subwords.

The pieces are those of an existing vocabulary file. Their probabilities come from the training texts: how
often the vocabulary's own segmentation of the words uses each piece, smoothed. A word's probability is the sum over
all ways to spell it with pieces; the forward recursion adds them up in logarithms, from left to right. Pieces do not
span blanks, so a text's probability is the product of its words' and of an end.

Each distinct word is scored once, in a table that grows with the corpus. The most frequent words, a
bounded number, are handed to every task; what a text holds beyond them is looked up by a join, in which by
construction no word is frequent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from lamina.llm.common import small_batches, stash, stash_seen, worker_cache

# Words that every task holds at most, and distinct words that a counting task gathers before it hands them on.
FREQUENT = 150_000
GATHERED = 200_000

# Bytes of texts whose words a counting task gathers at most, as a word may be a whole text.
GATHERED_BYTES = 64 << 20

# Bytes of a word that is handed to workers; where texts have no blanks a word may be a whole text.
WORD_BYTES = 64

SMOOTHING = 0.1
BLANK = "▁"


def count_words(docs: DataFrame, training: str, text: str = "_text") -> DataFrame:
    """(word, n): every distinct word of all texts, and its count in the texts where ``training`` is true."""

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        def handed(counts, others):
            words = [*counts, *(w for w in others if w not in counts)]
            numbers = [*counts.values(), *[0] * (len(words) - len(counts))]
            for i in range(0, len(words), 1 << 16):
                part = pa.array(words[i : i + (1 << 16)], pa.binary()).cast(pa.string())
                yield pa.record_batch([part, pa.array(numbers[i : i + (1 << 16)], pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        others: set[bytes] = set()
        held = 0
        for batch in batches:
            for learn, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                (counts if learn else others).update(value.lower().split() if value else ())
                held += len(value or b"")
            if len(counts) + len(others) > GATHERED or held > GATHERED_BYTES:
                yield from handed(counts, others)
                counts, others, held = Counter(), set(), 0
        yield from handed(counts, others)

    parts = docs.select(training, text).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def piece_counts(words: DataFrame, vocabulary: str) -> dict[int, int]:
    """How often the words' own segmentation uses each piece; at most one number per piece of the vocabulary."""

    def count(batches):
        import numpy as np
        import pyarrow as pa
        from sentencepiece import SentencePieceProcessor

        model = worker_cache("pieces", vocabulary, lambda: SentencePieceProcessor(model_file=vocabulary))
        total = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            lists = model.encode(batch.column(0).to_pylist(), num_threads=1)
            times = np.repeat(batch.column(1).to_numpy(), [len(x) for x in lists])
            total += np.bincount([i for x in lists for i in x], times, len(total)).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["piece", "n"])

    parts = words.filter("n > 0").select("word", "n").mapInArrow(count, "piece long, n long")
    return {r["piece"]: r["n"] for r in parts.groupBy("piece").agg(F.sum("n").alias("n")).collect()}


def least_frequent(words: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach, by a histogram of a few hundred counts at most."""
    exact = 256
    step = F.when(F.col("n") < exact, F.col("n")).otherwise(F.floor(F.log2("n") * 16) - 16 * 8 + exact)
    found = words.groupBy(step.cast("long").alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("n")).collect()
    least, total = 1 + max((r["n"] for r in found), default=0) * 2, 0
    for row in sorted(found, key=lambda r: -r["step"]):
        total += row["words"]
        if total > most:
            break
        least = row["n"]
    return max(1, least)


def handed_out(scored: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """The frequent words that workers hold, at most ``most`` and of ``WORD_BYTES`` at most; the others are joined."""
    return scored.filter((F.col("n") >= least_frequent(words, most)) & (F.octet_length("word") <= WORD_BYTES))


class Lattice:
    """Log10 probability of words: ``scores`` gives the pieces' natural logarithms by their text, bytes as numbers."""

    def __init__(self, scores: dict[str | int, float]):
        self.octets = [scores[b] for b in range(256)]
        self.root: dict = {}
        self.longest = max((len(p) for p in scores if isinstance(p, str)), default=1)
        for piece, score in scores.items():
            if isinstance(piece, str):
                node = self.root
                for letter in piece:
                    node = node.setdefault(letter, {})
                node[""] = score

    def word(self, word: str) -> float:
        """The forward recursion: ``reached[i]`` gathers the log weights of all spellings of the first i characters."""
        from math import exp, log

        line = BLANK + word
        # Only the positions that a piece from here can reach are open, however long the word is.
        arrivals: list[list[float] | None] = [[] for _ in range(self.longest + 1)]
        arrivals[0].append(0.0)
        for i, letter in enumerate(line):
            into = arrivals[i]
            arrivals[i] = None
            arrivals.append([])
            if len(into) == 1:
                here = into[0]
            else:
                most = max(into)
                here = most + log(sum([exp(x - most) for x in into]))
            # Every character can be spelled with its bytes, so every position is reached.
            arrivals[i + 1].append(here + sum([self.octets[b] for b in letter.encode("utf-8", "surrogatepass")]))
            node, j = self.root.get(letter), i + 1
            while node is not None:
                if "" in node:
                    arrivals[j].append(here + node[""])
                if j == len(line):
                    break
                node, j = node.get(line[j]), j + 1
        last = arrivals[len(line)]
        most = max(last)
        return (most + log(sum([exp(x - most) for x in last]))) / log(10)


def piece_scores(vocabulary: str, counts: dict[int, int], ends: int) -> tuple[dict, float]:
    """Natural log probabilities of the pieces (bytes by number) and of the end of a text."""
    from math import log

    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=vocabulary)
    numbers = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    total = log(sum(counts.get(i, 0) for i in numbers) + ends + SMOOTHING * (len(numbers) + 1))
    scores = {
        int(model.id_to_piece(i)[3:5], 16) if model.is_byte(i) else model.id_to_piece(i): log(counts.get(i, 0) + SMOOTHING) - total
        for i in numbers
    }
    for octet in range(256):
        scores.setdefault(octet, log(SMOOTHING) - total)
    return scores, (log(ends + SMOOTHING) - total) / log(10)


def score_words(words: DataFrame, scores: dict) -> DataFrame:
    """(word, n, lattice): the words with their log10 probability over all segmentations."""
    version = uuid.uuid4().hex

    def each(batches):
        import pyarrow as pa

        lattice = worker_cache(version, "lattice", lambda: Lattice(scores))
        for batch in batches:
            found = [lattice.word(w) for w in batch.column(0).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], names=["word", "n", "lattice"])

    return words.select("word", "n").mapInArrow(each, "word string, n long, lattice double")


def score_texts(
    docs: DataFrame,
    training: Column,
    vocabulary: str,
    doc_id: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Scores of all rows: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Rows where ``training`` is true teach, all are scored. A-Z are lower-cased; tokens are the words
    between ASCII blanks and an end, so an empty or NULL text has one token. ``base_score`` is
    the smoothed log10 probability of the tokens as they are, ``score`` that of the subword lattice. Each row is scored
    by itself, also where ids repeat or are NULL. Without training rows all counts are 0 and the scores
    come from the smoothing alone. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(training, F.lit(False)).alias("_learn"), F.col(text).alias("_text")
    )
    ends = rows.select("_learn").filter("_learn").count()
    words, seen = stash_seen(
        count_words(rows, "_learn"), "words", tokens=F.sum("n"), kinds=F.count_if(F.col("n") > 0)
    )
    known = (seen["tokens"] or 0) + ends
    kinds = seen["kinds"] + (1 if ends else 0)
    floor = known + SMOOTHING * (kinds + 1)
    scores, end_lattice = piece_scores(vocabulary, piece_counts(words, vocabulary), ends)
    scored = stash(score_words(words, scores), "scored-words")
    base = lambda n: F.log10((n + SMOOTHING) / F.lit(floor))
    top = handed_out(scored, words, frequent).toPandas()
    held = (top["word"].tolist(), top["n"].tolist(), top["lattice"].tolist())
    version = uuid.uuid4().hex

    def look(batches):
        from math import log10

        import pyarrow as pa
        from pyspark import TaskContext

        def table():
            return {
                w.encode("utf-8", "surrogatepass"): (n > 0, log10((n + SMOOTHING) / floor), x) for w, n, x in zip(*held)
            }

        get = worker_cache(version, "frequent", table).get
        end = (ends > 0, log10((ends + SMOOTHING) / floor), end_lattice)
        number = TaskContext.get().partitionId() << 40
        fields = ["row", "doc_id", "learn", "word", "n", "known", "base", "score"]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        for batch in batches:
            firsts, rest = [], []
            for doc, learn, value in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()
            ):
                tokens = value.lower().split() if value else []
                found = [get(w) for w in tokens]
                hits = [f for f in found if f is not None]
                if len(hits) < len(found):
                    own: dict[bytes, int] = {}
                    for w, f in zip(tokens, found):
                        if f is None:
                            own[w] = own.get(w, 0) + 1
                    rest += [(number, w, n) for w, n in own.items()]
                firsts.append(
                    (
                        number,
                        doc,
                        learn,
                        None,
                        len(tokens) + 1,
                        sum([h[0] for h in hits]) + end[0],
                        sum([h[1] for h in hits]) + end[1],
                        sum([h[2] for h in hits]) + end[2],
                    )
                )
                number += 1
            if firsts:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*firsts), kinds)], names=fields)
            for i in range(0, len(rest), 1 << 16):
                part = list(zip(*rest[i : i + (1 << 16)]))
                size = len(part[0])
                yield pa.record_batch(
                    [
                        pa.array(part[0], pa.int64()),
                        pa.nulls(size, pa.int64()),
                        pa.nulls(size, pa.bool_()),
                        pa.array(part[1], pa.binary()).cast(pa.string()),
                        pa.array(part[2], pa.int64()),
                        *[pa.nulls(size, k) for k in kinds[5:]],
                    ],
                    names=fields,
                )

    looked = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "_learn", "_text").mapInArrow(
        look, "row long, doc_id long, learn boolean, word string, n long, known long, base double, score double"
    )
    # Stored once, so row numbers stay what they are whatever task runs again afterwards.
    looked = stash(looked, "looked-up")
    firsts = looked.filter(F.col("word").isNull()).drop("word")
    rare = looked.filter(F.col("word").isNotNull()).select("row", "word", F.col("n").alias("times"))
    found = rare.join(scored, "word").select(
        "row",
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("boolean").alias("learn"),
        F.lit(0).cast("long").alias("n"),
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * base(F.col("n"))).alias("base"),
        (F.col("times") * F.col("lattice")).alias("score"),
    )
    sums = {"n_tokens": "n", "n_known": "known", "base_score": "base", "score": "score"}
    whole = firsts.unionByName(found).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), (~F.bool_or("learn")).alias("held_out"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(known).cast("long").alias("train_tokens"), "base_score", "score"
    )
