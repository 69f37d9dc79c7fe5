"""Language identification by hyperdimensional profiles.

Every letter, of whatever script, has a random vector of +1 and -1 that is drawn from a hash of its code point. A trigram is the letters' vectors, the first permuted twice, the second
once and the third not at all, bound by multiplication; a text is the sum (bundle) of its trigrams, and a
language is the bundle of its labelled texts. A text has the language whose prototype has the greatest
cosine with it.

Trigrams are taken around each letter, so that a neighbour is a letter or the edge of a word. A text's
bundle is the product of its trigram counts and the trigrams' vectors, which makes it one matrix
product per block of texts. Long texts are counted piece by piece, each with one more character on either side, and their
bundles added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame, functions as F

from lamina.llm.common import runs_of, small_batches, worker_cache

# Dimensions of the vectors, and the seed of the letters' vectors.
DIMENSIONS = 1024
SEED = 20

# Code points there are; 0 stands for the edge of a word.
POINTS = 0x110000

# Characters, trigrams and trigram counts handled at a time.
CHARACTERS = 1 << 20
TRIGRAMS = 4096
CELLS = 1 << 24

UNKNOWN = "und"


@dataclass(frozen=True)
class Profiles:
    """Prototypes: one row of ``vectors`` per language, in the order of ``languages``."""

    languages: list[str]
    vectors: list[list[float]]
    dimensions: int = DIMENSIONS


def _is_letter():
    """Of each code point, whether it is a letter."""
    import numpy as np

    return np.fromiter((chr(point).isalpha() for point in range(POINTS)), bool, POINTS)


def _letter_vectors(alphabet, dimensions: int):
    """The vectors of these code points, +1 and -1, from a mixing hash of point and place: the same in every worker."""
    import numpy as np

    words = -(-dimensions // 64)
    x = alphabet.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    x = (x + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    # The finalizer of the splitmix64 generator.
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(len(alphabet), -1), axis=1)[:, :dimensions]
    return bits.astype(np.int8) * 2 - 1


def _distinct(codes, most: int):
    """The distinct codes below ``most``, ascending, and the place of each code among them."""
    import numpy as np

    if most > CELLS:
        return np.unique(codes, return_inverse=True)
    seen = np.zeros(most, bool)
    seen[codes] = True
    distinct = np.flatnonzero(seen)
    place = np.zeros(most, np.int32)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[codes]


def _pieces(texts: list[str]) -> Iterator[tuple[int, list[str], int, int]]:
    """First text, lower-cased texts, and how many characters before and after them are only neighbours.

    Short texts come in runs; one of more than ``CHARACTERS`` comes in several pieces of its own.
    """
    lows = [t.lower() for t in texts]
    for begin, end in runs_of([len(t) for t in lows], CHARACTERS):
        whole = len(lows[begin])
        if end - begin > 1 or whole <= CHARACTERS:
            yield begin, lows[begin:end], 0, 0
            continue
        for cut in range(0, whole, CHARACTERS):
            before, after = int(cut > 0), int(cut + CHARACTERS < whole)
            yield begin, [lows[begin][cut - before : cut + CHARACTERS + after]], before, after


def _counted(texts: list[str], cells: int = CELLS) -> Iterator[tuple]:
    """Blocks of texts: first text, alphabet, trigrams of its letters, the number of each text's letters, counts (texts x trigrams).

    A block whose counts would have more than ``cells`` numbers is halved, down to single texts. So many short texts, or a
    script of many letters, need no more memory than others. The blocks of one long text follow each other.
    """
    import numpy as np

    is_letter = worker_cache("language", "letters", _is_letter)
    for begin, lows, before, after in _pieces(texts):
        line = "\n" + "\n".join(lows) + "\n"
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(is_letter[points], points, 0)
        known = np.zeros(POINTS, np.int32)
        known[points] = 1
        known[0] = 1
        alphabet = np.flatnonzero(known)
        known[alphabet] = np.arange(len(alphabet))
        letters, base = known[points].astype(np.int64), len(alphabet)
        middle = np.flatnonzero(letters)
        middle = middle[(middle > before) & (middle < len(line) - 1 - after)]
        code = (letters[middle - 1] * base + letters[middle]) * base + letters[middle + 1]
        sizes = np.array([len(t) + 1 for t in lows])
        text = np.searchsorted(np.cumsum(sizes), middle - 1, side="right")
        open_ = [(0, len(sizes))]
        while open_:
            first, stop = open_.pop()
            many = stop - first
            i, j = np.searchsorted(text, (first, stop))
            codes, place = _distinct(code[i:j], base**3)
            if many > 1 and many * len(codes) > cells:
                half = (first + stop) // 2
                open_ += [(half, stop), (first, half)]
                continue
            own = text[i:j] - first
            counts = np.bincount(own * len(codes) + place, minlength=many * len(codes))
            counts = counts.reshape(many, len(codes)).astype(np.float32)
            yield begin + first, alphabet, codes, np.bincount(own, minlength=many), counts


def _bundled(alphabet, codes, counts, dimensions: int):
    """Bundles of the rows of ``counts``."""
    import numpy as np

    base, plain = len(alphabet), _letter_vectors(alphabet, dimensions)
    twice, once = np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1)
    total = np.zeros((len(counts), dimensions), np.float64)
    for i in range(0, len(codes), TRIGRAMS):
        part = codes[i : i + TRIGRAMS]
        bound = twice[part // base**2] * once[part // base % base] * plain[part % base]
        total += counts[:, i : i + TRIGRAMS] @ bound.astype(np.float32)
    return total


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes of all labelled texts; rows without text or label teach nothing.

    Each task bundles its own texts per language and hands on one vector per language; these are summed by
    language and dimension. The driver receives as many numbers as languages have dimensions, whatever
    the number of texts. No labelled text gives no languages.
    """
    small_batches(labelled.sparkSession)

    def bundle(batches):
        import numpy as np
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = (c.to_pylist() for c in batch.columns)
            for begin, alphabet, codes, _, counts in _counted(texts):
                own = np.array(langs[begin : begin + len(counts)])
                names = sorted(set(own.tolist()))
                each = np.stack([counts[own == name].sum(axis=0) for name in names])
                for name, vector in zip(names, _bundled(alphabet, codes, each, dimensions)):
                    sums[name] = sums.get(name, 0) + vector
        for name, vector in sums.items():
            yield pa.record_batch(
                [pa.array([name], pa.string()), pa.array([vector.tolist()], pa.list_(pa.float64()))],
                names=["lang", "vector"],
            )

    known = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).dropna()
    parts = known.mapInArrow(bundle, "lang string, vector array<double>")
    single = parts.select("lang", F.posexplode("vector").alias("dim", "value"))
    sums = single.groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    whole = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "value"))).alias("v"))
    rows = sorted(whole.select("lang", "v.value").collect())
    return Profiles([r[0] for r in rows], [list(r[1]) for r in rows], dimensions)


def predict(
    docs: DataFrame,
    profiles: Profiles,
    keys: list[str],
    text: str = "text",
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """The key columns, ``lang_pred`` and ``score`` (or other ``names``), the cosine with the prototype, from 0 to 1.

    A NULL text, one without a letter, and any text where no language was learned are ``und`` with
    score 0. Of languages that are equally near, the first by name is taken. Only the text is looked at.
    """
    import numpy as np

    small_batches(docs.sparkSession)
    languages, dimensions = [*profiles.languages, UNKNOWN], profiles.dimensions
    matrix = np.array(profiles.vectors, np.float64).reshape(-1, dimensions)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)

    def classify(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            best = np.full(len(texts), len(languages) - 1)
            score = np.zeros(len(texts))
            for begin, pieces in groupby(_counted(texts) if len(matrix) else (), itemgetter(0)):
                letters, bundles = 0, 0
                for _, alphabet, codes, each, counts in pieces:
                    letters, bundles = letters + each, bundles + _bundled(alphabet, codes, counts, dimensions)
                norms = np.maximum(np.linalg.norm(bundles, axis=1), 1e-300)
                cosines = bundles @ matrix.T / norms[:, None]
                rows = begin + np.flatnonzero(letters)
                cosines = cosines[letters > 0]
                best[rows] = cosines.argmax(axis=1)
                score[rows] = np.clip(cosines.max(axis=1, initial=0), 0, 1)
            found = [pa.array([languages[i] for i in best], pa.string()), pa.array(score)]
            yield pa.record_batch([*batch.columns[:-1], *found], names=[*keys, *names])

    chosen = docs.select(*keys, F.col(text).alias("_lamina_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(classify, f"{kinds}`{names[0]}` string, `{names[1]}` double")


def keep_identified(docs: DataFrame, profiles: Profiles, text: str = "text", lang: str | None = None) -> DataFrame:
    """The rows whose language was identified; NULL texts and texts without a letter go.

    A NULL in the column ``lang``, if one is named, becomes the language that was found; all else is kept as it
    is. The text is classified on the way, so nothing is shuffled.
    """
    names = ("_lamina_lang", "_lamina_score")
    kept = predict(docs, profiles, docs.columns, text, names).filter(F.col(names[0]) != UNKNOWN)
    filled = kept if lang is None else kept.withColumn(lang, F.coalesce(F.col(lang), F.col(names[0])))
    return filled.select(*docs.columns)
