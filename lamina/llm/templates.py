"""Benchmark decontamination by templates.

Texts are brought into a canonical form in which numbers, names and units are typed placeholders, so
that a question with other parameters has the same template. Windows of five words are joined by their hash in two
forms: canonical, and plain, that is lower-cased without punctuation around words, so that neither case nor line breaks
nor end marks matter to a copy. A document holds a benchmark item if at least 0.8 of the item's windows occur in it in either form. Along one
alignment a value of the item stands for one value of the document, the one it has most often; windows with
another value do not count there, unless all their slots are those of the item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lamina.llm.common import ROW_KEY, row_key, runs_of, small_batches, stash, worker_cache
from lamina.operators.joins import lookup_join

WINDOW = 5
SIMILARITY = 0.8

# Bits of the filter of benchmark window hashes that every worker holds; its size does not depend on the data.
FILTER_BITS = 1 << 22

# Words handled at a time, and canonical words that a worker remembers, with the letters of the longest of them.
WORDS = 1 << 18
REMEMBERED = 200_000
LONGEST = 64

# Letters of scripts that put no blanks between words (Thai, Lao, Burmese, Khmer, Japanese, Chinese), and their punctuation.
UNBROKEN = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
MARKS = "\u3000-\u303f\uff01-\uff0f\uff1a-\uff20\uff61-\uff65"

# Units and their usual abbreviations.
UNITS = (
    "mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles meter meters metre metres kilometer "
    "kilometers kilometre kilometres mg g kg gram grams kilogram kilograms ton tons tonne tonnes oz ounce ounces "
    "lb lbs pound pounds ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes "
    "h hr hour hours day days week weeks month months year years hz khz mhz ghz w kw watt watts v volt volts "
    "j kj joule joules n newton newtons pa kpa k kelvin celsius fahrenheit degree degrees percent % $ € £ dollar "
    "dollars cent cents euro euros kmh mph"
).split()

_NUMBER = r"[+-]?[$€£]?(?:\d[\d.,:/]*\d|\d)(?:st|nd|rd|th)?%?"


class Canonicaliser:
    """Canonical words: per word a hash, and whether it is a slot.

    A word is what stands between blanks, without punctuation around it, lower-cased; in scripts that put no blanks between
    words each letter is one, and their punctuation is a blank. A number is
    a placeholder; a unit is one after a number, in the same word or the next; a name is a capitalised word
    within a sentence. A line or a sentence begins anew, so its first word is no name.

    What a word is by itself is found once and remembered by number, for a bounded number of words that were met in
    two blocks or more. The other words of a block have numbers after these until the next block.
    """

    NUMBER, QUANTITY, UNIT, NAME = 1, 2, 3, 4

    def __init__(self):
        import re

        import numpy as np
        from xxhash import xxh64_intdigest

        self.number, self.units = re.compile(_NUMBER), frozenset(UNITS)
        self.unbroken = re.compile(f"[{UNBROKEN}]").search
        self.apart = re.compile(f"[{UNBROKEN}]|[{MARKS}]+").sub
        self.joined = re.compile(rf"({_NUMBER})([A-Za-z%$€£]+)")
        self.marks = np.array([0, *(xxh64_intdigest(b"\x00%d" % k) for k in (1, 2, 3, 4))], np.uint64)
        self.hash = xxh64_intdigest
        self.places: dict[str, int] = {}
        self.once: set[str] = set()
        self.passing: dict[str, int] = {}
        self._forget()

    def _forget(self):
        from array import array

        self.places.clear()
        self.plain, self.kind, self.ends, self.low = array("Q"), array("b"), array("b"), []

    def _settle(self):
        """Keep the words of the last block that were met before it, and drop the others' numbers."""
        if len(self.places) > REMEMBERED:
            self._forget()
            self.passing.clear()
        kept = len(self.places)
        for word, place in self.passing.items():
            if len(word) <= LONGEST and word in self.once:
                self.plain[kept], self.kind[kept], self.ends[kept] = self.plain[place], self.kind[place], self.ends[place]
                self.low[kept] = self.low[place]
                self.places[word] = kept
                kept += 1
        for values in (self.plain, self.kind, self.ends, self.low):
            del values[kept:]
        if len(self.once) > REMEMBERED:
            self.once.clear()
        self.once.update(w for w in self.passing if len(w) <= LONGEST)
        self.passing.clear()

    def _learned(self, word: str) -> int:
        kind, ends = 0, False
        if word.isalpha() and word.islower():
            low = word
            kind = self.UNIT if low in self.units else 0
        else:
            bare = word.strip(".,;:!?\"'()[]{}<>|*#`´‘’“”«»¡¿…–—-&") or word
            low = bare.lower()
            if bare[:1].isdigit() or bare[1:2].isdigit() or bare[2:3].isdigit():
                if self.number.fullmatch(bare):
                    kind = self.NUMBER
                elif (m := self.joined.fullmatch(bare)) and m[2].lower() in self.units:
                    kind = self.QUANTITY
            elif low in self.units:
                kind = self.UNIT
            elif bare[:1].isupper():
                kind = self.NAME
            ends = word == "|" or word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":")
        self.plain.append(self.hash(low.encode("utf-8", "surrogatepass")))
        self.kind.append(kind)
        self.ends.append(ends)
        self.low.append(low)
        self.passing[word] = place = len(self.low) - 1
        return place

    def block(self, texts: list[str]):
        """Words of texts as numbers, first word of each text, plain and canonical hashes, slots; the numbers hold until the next block."""
        import numpy as np

        self._settle()
        words: list[str] = []
        begins, lines = [], []
        for text in texts:
            begins.append(len(words))
            if not text.isascii() and self.unbroken(text):
                text = self.apart(lambda m: f" {m[0]} " if self.unbroken(m[0]) else " ", text)
            for line in text.split("\n"):
                lines.append(len(words))
                words += line.split()
        places = list(map(self.places.get, words))
        if None in places:
            for i, word in enumerate(words):
                if places[i] is None:
                    place = self.passing.get(word)
                    places[i] = self._learned(word) if place is None else place
        place = np.array(places, np.int64)
        # Copies, as an array cannot grow while it is looked at.
        plain, kind, ends = (np.frombuffer(x.tobytes(), t) for x, t in ((self.plain, np.uint64), (self.kind, np.int8), (self.ends, bool)))
        plain, kind = plain[place], kind[place]
        start = np.ones(len(words) + 1, bool)
        start[1:] = ends[place]
        after = np.zeros(len(words) + 1, bool)
        after[1:] = kind == self.NUMBER
        start[lines], after[lines] = True, False
        slots = (kind == self.NUMBER) | (kind == self.QUANTITY)
        slots |= (kind == self.UNIT) & after[:-1] | (kind == self.NAME) & ~start[:-1]
        return places, begins, plain, np.where(slots, self.marks[kind], plain), slots


def _codes(hashes, size: int):
    """Hashes of all windows of ``size`` words."""
    import numpy as np

    n = len(hashes) - size + 1
    code = np.zeros(n, np.uint64)
    for i in range(size):
        code = (code ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return code


def _windows(texts: list[str], lengths: list[int]):
    """Blocks of texts and each length: text numbers, sizes of the texts, positions, plain and canonical hashes, slot bits, whether a
    window is within a text, and the words."""
    import numpy as np

    canonical = worker_cache("templates", "canonical", Canonicaliser)
    for begin, end in runs_of([len(t) // 4 for t in texts], WORDS):
        places, begins, plain, hashes, slots = canonical.block(texts[begin:end])
        sizes = np.diff(np.append(begins, len(hashes)))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for length in lengths:
            n = len(hashes) - length + 1
            if n < 1:
                continue
            bits = np.zeros(n, np.int64)
            for i in range(length):
                bits |= slots[i : i + n].astype(np.int64) << i
            own = owner[:n]
            whole = own == owner[length - 1 :]
            pos = np.arange(n) - np.array(begins)[own]
            yield begin, length, own, sizes, pos, _codes(plain, length), _codes(hashes, length), bits, whole, (canonical.low, places)


def _emit(docs: DataFrame, keys: list[str], text: str, size: int, hits: bytes | None = None, short: list[int] | None = None) -> DataFrame:
    """Windows of each row: the keys, ``pos``, ``h``, ``w``, ``said``, ``length`` and the values of its slots.

    Each window has a row with its plain hash, which is also its ``w``, and if it has slots one with its canonical hash.
    ``said`` is false for windows of placeholders only, whose canonical form says nothing and is left out. Without
    ``hits`` these are windows of items, and an item of fewer than ``size`` words is one plain window.
    With ``hits`` only rows whose hash is in the filter, slots in canonical rows only, and of windows of the ``short`` lengths
    the first in a text.
    """
    small_batches(docs.sparkSession)
    lengths = [*(range(1, size) if hits is None else short or []), size]

    def each(batches):
        import numpy as np
        import pyarrow as pa

        wanted = None if hits is None else np.unpackbits(np.frombuffer(hits, np.uint8), bitorder="little")
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for begin, length, owner, sizes, pos, plain, code, bits, whole, (low, places) in _windows(texts, lengths):
                said = bits != (1 << length) - 1
                forms = [(plain, whole), (code, whole & said & (bits != 0))]
                if length < size:
                    said = np.ones(len(bits), bool)
                    forms = [(plain, whole & (sizes[owner] == length) if wanted is None else whole)]
                for h, holds in forms:
                    if wanted is not None:
                        holds = holds & (wanted[h % np.uint64(FILTER_BITS)] == 1)
                    at = np.flatnonzero(holds)
                    if length < size and len(at):
                        at = at[np.sort(np.unique(np.rec.fromarrays([owner[at], h[at]]), return_index=True)[1])]
                    if not len(at):
                        continue
                    shown = bits[at] if length == size and (wanted is None or h is code) else np.zeros(len(at), np.int64)
                    values = [
                        [low[places[w + i]] if b >> i & 1 else None for i in range(size)] if b else None
                        for w, b in zip(at.tolist(), shown.tolist())
                    ]
                    rows = pa.array(begin + owner[at])
                    columns = [c.take(rows) for c in batch.columns[:-1]]
                    columns += [pa.array(pos[at]), pa.array(h[at].view(np.int64)), pa.array(plain[at].view(np.int64))]
                    columns += [pa.array(said[at]), pa.array(np.full(len(at), length, np.int32)), pa.array(values, pa.list_(pa.string()))]
                    yield pa.record_batch(columns, names=[*keys, "pos", "h", "w", "said", "length", "slots"])

    chosen = docs.select(*keys, F.col(text).alias("_lamina_text"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(each, f"{kinds}pos long, h long, w long, said boolean, length int, slots array<string>")


def _filter_of(windows: DataFrame) -> bytes:
    """Bit filter of the window hashes, built from at most ``FILTER_BITS`` distinct places."""
    import numpy as np

    # The hash is unsigned for the worker, so the remainder is taken of its last bits.
    places = windows.select(F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)).cast("int").alias("p")).distinct()
    octet = places.groupBy(F.shiftright("p", 3).alias("octet")).agg(F.bit_or(F.expr("shiftleft(1, p % 8)")).alias("bits"))
    found = octet.toPandas()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    bits[found["octet"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bits.tobytes()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(keys, ``item_id``, ``n_windows``, ``matched``, ``similarity``, ``reparameterised``) of each row and item it holds.

    ``reparameterised`` tells that a slot has another value than in the item. An item with fewer than
    ``size`` words is one window of its own length, held where these words occur; so an item of one word is held by every
    text with this word. Windows of placeholders only match where they are literally equal. An item is held by its share of
    windows without these, which are not expected of a question with other parameters, or by its share of all its windows;
    ``n_windows`` and ``matched`` are those of the first where it suffices. NULL texts hold nothing. Equal items are each reported;
    an item is an id and a text, so texts that share an id are items of their own. Rows of ``docs`` with equal keys are
    found together, so the keys should tell texts apart (``row_key``).

    Every worker filters the windows of its documents by a bit filter of the benchmark's hashes, of a
    fixed size; only windows that may match are joined. With a benchmark so large that the filter
    is full, all windows are joined and the result is the same. Documents meet items by the items' rarest windows only
    (``_rarest``), so a phrase that many items share does not join every document that has it with all of them.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("_lamina_text"))
    items = items.withColumn("item", F.to_json(F.struct("item_id", F.xxhash64("_lamina_text").alias("text"))))
    asked = _emit(items, ["item", "item_id"], "_lamina_text", size).withColumnsRenamed({"pos": "nth", "slots": "asked"})
    asked = asked.withColumn("said", F.bool_or("said").over(Window.partitionBy("item", "w")))
    asked = stash(asked, "benchmark-windows")
    short = sorted(r["length"] for r in asked.select("length").distinct().collect() if r["length"] < size)
    rarest = stash(_rarest(asked.select("item", "w", "said", "h").distinct(), similarity), "rarest-windows")
    found = _emit(docs, keys, text, size, _filter_of(asked), short).select(*keys, "pos", "h", "slots")
    found = stash(found, "document-windows")
    met = stash(found.select(*keys, "h").join(rarest, "h").select(*keys, "item", "n_said", "n_all").distinct(), "candidates")
    none = F.array().cast("array<string>")
    same = [found[k].eqNullSafe(met[k]) for k in keys]
    joined = met.join(asked, "item").join(found, [*same, found["h"] == asked["h"]])
    joined = joined.select(*[met[k] for k in keys], "item", "item_id", "n_said", "n_all", "pos", "nth", "w", "said", "asked", "slots")
    # Where the plain forms are equal, so are the slots.
    window = F.struct("nth", "w", "said", F.coalesce("asked", none).alias("a"), F.coalesce("slots", "asked", none).alias("b"))
    # Copies of a passage in many documents make equal rows of small size; nothing larger than the slots of a
    # document's own windows is ever gathered.
    along = [*keys, "item", "item_id", "n_said", "n_all"]
    lines = joined.groupBy(*along, (F.col("pos") - F.col("nth")).alias("shift")).agg(F.collect_set(window).alias("windows"))
    total = lambda name: F.size(F.array_distinct(F.flatten(F.collect_list(name))))
    held = _consistent(lines, along).groupBy(*along).agg(
        total("said").alias("m_said"), total("ws").alias("m_all"), F.bool_or("changed").alias("reparameterised")
    )
    by_said = (F.col("n_said") > 0) & (F.col("m_said") >= _needed("n_said", similarity))
    by_all = F.col("m_all") >= _needed("n_all", similarity)
    counted = held.filter(by_said | by_all).withColumns(
        {
            "n_windows": F.when(by_said, F.col("n_said")).otherwise(F.col("n_all")),
            "matched": F.when(by_said, F.col("m_said")).otherwise(F.col("m_all")),
        }
    )
    share = F.col("matched") / F.col("n_windows")
    return counted.select(*keys, "item_id", "n_windows", "matched", share.alias("similarity"), "reparameterised")


def _kept(windows: list[dict]) -> tuple[list[int], list[int], bool]:
    """Windows of an alignment that count, those that are not of placeholders only, and whether a slot has another value than in the item."""
    from collections import Counter, defaultdict

    slots = {(w["nth"] + i, a, b) for w in windows for i, (a, b) in enumerate(zip(w["a"], w["b"])) if a is not None}
    votes: defaultdict[str, Counter] = defaultdict(Counter)
    for _, a, b in slots:
        votes[a][b] += 1
    # Of values that occur equally often, the item's own goes first.
    stands = {a: min(found, key=lambda b: (-found[b], a != b, b)) for a, found in votes.items()}
    counted = [w for w in windows if w["a"] == w["b"] or all(a is None or stands[a] == b for a, b in zip(w["a"], w["b"]))]
    ws, said = {w["w"] for w in counted}, {w["w"] for w in counted if w["said"]}
    return sorted(ws), sorted(said), any(w["a"] != w["b"] for w in counted)


def _consistent(lines: DataFrame, along: list[str]) -> DataFrame:
    """(along, ``ws``, ``said``, ``changed``) of each alignment, by ``_kept``."""
    small_batches(lines.sparkSession)

    def each(batches):
        import pyarrow as pa

        for batch in batches:
            found = [_kept(windows.as_py()) for windows in batch.column(batch.num_columns - 1)]
            ws, said = (pa.array([f[i] for f in found], pa.list_(pa.int64())) for i in (0, 1))
            columns = [*batch.columns[:-1], ws, said, pa.array([f[2] for f in found], pa.bool_())]
            yield pa.record_batch(columns, names=[*along, "ws", "said", "changed"])

    chosen = lines.select(*along, "windows")
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(each, f"{kinds}ws array<long>, said array<long>, changed boolean")


def _needed(windows: str, similarity: float):
    """How many of an item's ``windows`` a document has to hold."""
    return F.ceil(F.col(windows) * similarity - 1e-9)


def _rarest(windows: DataFrame, similarity: float) -> DataFrame:
    """(item, h, n_said, n_all): both forms of those windows of each item that fewest items have, one more than a document may lack.

    A document that holds the item lacks at most ``n - needed`` of its windows, so it has one of these in a form. This
    holds for all windows and for those that are not of placeholders only; each has its rarest here.
    """
    spread = windows.select("item", "h").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("items"))
    forms = lookup_join(windows, spread, "h", "inner").groupBy("item", "w", "said")
    forms = forms.agg(F.max("items").alias("items"), F.collect_set("h").alias("hs"))
    own, alike = Window.partitionBy("item"), Window.partitionBy("item", "said")
    ranked = forms.withColumns(
        {
            "n_all": F.count(F.lit(1)).over(own),
            "n_said": F.count_if("said").over(own),
            "place": F.row_number().over(own.orderBy("items", "w")),
            "place_said": F.row_number().over(alike.orderBy("items", "w")),
        }
    )
    least = lambda place, n: F.col(place) <= F.col(n) - _needed(n, similarity) + 1
    chosen = ranked.filter(least("place", "n_all") | F.col("said") & least("place_said", "n_said"))
    return chosen.select("item", F.explode("hs").alias("h"), "n_said", "n_all").distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    named = docs.withColumns(row_key(doc_id, text))
    bad = stash(contaminated(named, benchmark, list(ROW_KEY), text, **options).select(*ROW_KEY).distinct(), "contaminated")
    return lookup_join(named, bad, list(ROW_KEY), "left_anti").select(*docs.columns)
