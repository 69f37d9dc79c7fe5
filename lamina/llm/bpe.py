"""BPE encoding and decoding with tree concatenation for long texts.

A text of more than ``LEAF`` code points is cut into halves, and these again, until each piece is short. The
pieces are encoded side by side by different tasks. Then neighbours are joined, pairs of pairs, up to the
whole text. At each join the last tokens of the left side and the first of the right are encoded again as one
window; where the window begins with the left side's own tokens and ends with the right side's, up to
places where a token's border cannot depend on what lies beyond, both sides agree exactly and are joined through the
window. Otherwise the window doubles; at the latest it is the whole text.

Why agreement is enough: a border between two tokens is certain if it is a border of the split that precedes the
merges, or if it lies within one piece of that split and the two tokens are neighbours in an encoding
of text on both sides of it, since a sequence of tokens is what merging gives if and only if each two neighbours are. The
window supplies the neighbours. Places less than ``GUARD`` code points from the cut do not count, so that a
special token that the cut has parted lies wholly inside the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lamina.llm.common import small_batches, worker_cache
from lamina.llm.tokens import Encoder, Memory, octet_letters

# Code points beyond which a text is cut, and tokens on each side of a join's first window.
LEAF = 1 << 15
FIRST_WINDOW = 64
GUARD = 32

# Code points that are looked at on each side of a border.
BEFORE, AFTER = 4, 3


class TreeEncoder:
    """Exact ids of texts: short ones piece by piece, long ones as a tree of halves."""

    def __init__(self, path: str, leaf: int = LEAF):
        self.encoder = Encoder(path)
        self.leaf = leaf
        self.memory = Memory(self.encoder, "i")
        self.octets = token_octets(path)

    def packed(self, text: str) -> bytes:
        """Ids of a text that is not cut, as 32-bit integers."""
        return self.memory.packed(text)

    def leaves(self, text: str) -> list[str]:
        if len(text) <= self.leaf:
            return [text]
        half = len(text) // 2
        return self.leaves(text[:half]) + self.leaves(text[half:])

    def ids(self, text: str) -> list[int]:
        from array import array

        return self.concatenated([(part, list(array("i", self.packed(part)))) for part in self.leaves(text)])[1]

    def concatenated(self, parts: list[tuple[str, list[int]]]) -> tuple[str, list[int]]:
        """Join encoded neighbours two by two until one is left."""
        while len(parts) > 1:
            joined = [self.joined(*parts[i], *parts[i + 1]) for i in range(0, len(parts) - 1, 2)]
            parts = joined + parts[len(joined) * 2 :]
        return parts[0]

    def certain(self, text: str, at: int) -> bool:
        """Whether ``at``, a border of tokens on both sides' evidence, is one in the whole text too."""
        if text[at] in " \t\n\x0b\x0c\r" and not text[at - 1].isspace():
            return True
        around = text[max(0, at - BEFORE) : at + AFTER]
        if len(around) < BEFORE + AFTER:
            return False
        return len(self.encoder.tokenizer.pre_tokenizer.pre_tokenize_str(around)) == 1

    def joined(self, left: str, a: list[int], right: str, b: list[int]) -> tuple[str, list[int]]:
        text = left + right
        many = FIRST_WINDOW
        while True:
            s, begin = self._edge(a, many, left, before=True)
            e, end = self._edge(b, many, right, before=False)
            window = self.encoder.tokenizer.encode(left[begin:] + right[:end], add_special_tokens=False).ids
            if self._agrees_left(text, len(left), begin, a[s:], window) and self._agrees_right(
                text, len(left), len(left) + end, b[:e], window
            ):
                return text, a[:s] + window + b[e:]
            many *= 2

    def _edge(self, ids: list[int], many: int, text: str, before: bool) -> tuple[int, int]:
        """Tokens and code points outside a window of ``many`` tokens, where both have a border."""
        octets = self.octets
        step = min(many, len(ids))
        while True:
            kept = ids[len(ids) - step :] if before else ids[:step]
            line = b"".join([octets[i] for i in kept])
            rest = len(ids) - step
            try:
                size = len(line.decode())
            except UnicodeDecodeError:
                step += 1
                continue
            return (rest, len(text) - size) if before else (step, size)

    def _agrees_left(self, text: str, cut: int, begin: int, own: list[int], window: list[int]) -> bool:
        if begin == 0:
            return True
        line, at = b"", begin
        for x, y in zip(own, window):
            if x != y:
                return False
            line += self.octets[x]
            if not _whole(line):
                continue
            at, line = at + len(line.decode()), b""
            if at > cut - GUARD:
                return False
            if self.certain(text, at):
                return True
        return False

    def _agrees_right(self, text: str, cut: int, end: int, own: list[int], window: list[int]) -> bool:
        if end == len(text):
            return True
        line, at = b"", end
        for x, y in zip(reversed(own), reversed(window)):
            if x != y:
                return False
            line = self.octets[x] + line
            if not _whole(line):
                continue
            at, line = at - len(line.decode()), b""
            if at < cut + GUARD:
                return False
            if self.certain(text, at):
                return True
        return False


def _whole(line: bytes) -> bool:
    try:
        line.decode()
    except UnicodeDecodeError:
        return False
    return True


def token_octets(path: str) -> list[bytes]:
    """The bytes of each token by its id."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    octet = {letter: n for n, letter in enumerate(octet_letters())}
    table = [b""] * (max(vocabulary.values()) + 1)
    for token, n in vocabulary.items():
        plain = all(c in octet for c in token)
        table[n] = bytes(octet[c] for c in token) if plain else token.encode()
    return table


def _lists(parts: list[bytes]):
    """An Arrow array of lists of 32-bit integers from their bytes."""
    import numpy as np
    import pyarrow as pa

    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def _kinds(df: DataFrame, columns: list[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)


def encode(
    docs: DataFrame, vocabulary: str, keys: list[str], text: str = "text", leaf: int = LEAF, decoded: bool = False
) -> DataFrame:
    """The key columns and ``ids`` of each row, as the library's ``encode(text, add_special_tokens=False)``.

    NULL is empty and has no ids. Texts of at most ``leaf`` code points are encoded where they are. Longer ones
    are cut, their pieces dealt to all tasks, and put together again by row; copies of a long row are encoded once
    and each returned. Only one row's text and ids are ever together in memory. With ``decoded`` the ids
    are decoded again on the way, as ``decode`` does.
    """
    small_batches(docs.sparkSession)
    kinds = _kinds(docs, keys)
    row = f"{kinds}`_hash` string, `_copies` long, "
    tail = "ids array<int>" + (", decoded string" if decoded else "")

    def tree_of():
        return worker_cache("tree", f"{vocabulary} {leaf}", lambda: TreeEncoder(vocabulary, leaf))

    def with_ids(columns, names, parts, tree):
        import pyarrow as pa

        columns, names = [*columns, _lists(parts)], [*names, "ids"]
        if decoded:
            from array import array

            texts = [_decoded(array("i", p), tree.octets) for p in parts]
            columns, names = [*columns, pa.array(texts, pa.string())], [*names, "decoded"]
        return pa.record_batch(columns, names=names)

    def short(batches):
        tree = tree_of()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            yield with_ids(batch.columns[:-1], keys, [tree.packed(t) if t else b"" for t in texts], tree)

    def cut(batches):
        import pyarrow as pa

        tree = tree_of()
        for batch in batches:
            for n, value in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                parts = tree.leaves(value)
                rows = pa.array([n] * len(parts))
                columns = [c.take(rows) for c in batch.columns[:-1]]
                columns += [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.string())]
                yield pa.record_batch(columns, names=[*keys, "_hash", "_copies", "nth", "part"])

    def encode_parts(batches):
        import pyarrow as pa

        tree = tree_of()
        for batch in batches:
            ids = _lists([tree.packed(t) for t in batch.column(batch.num_columns - 1).to_pylist()])
            yield pa.record_batch([*batch.columns, ids], names=[*keys, "_hash", "_copies", "nth", "part", "ids"])

    def join(batches):
        from array import array

        tree = tree_of()
        for batch in batches:
            rows = []
            for parts in batch.column(batch.num_columns - 1).to_pylist():
                ordered = sorted(parts, key=lambda p: p["nth"])
                rows.append(array("i", tree.concatenated([(p["part"], p["ids"]) for p in ordered])[1]).tobytes())
            yield with_ids(batch.columns[:-1], [*keys, "_copies"], rows, tree)

    long = F.coalesce(F.length(text) > leaf, F.lit(False))
    whole = docs.filter(~long).select(*keys, F.col(text).alias("_lamina_text")).mapInArrow(short, kinds + tail)
    rows = docs.filter(long).groupBy(*keys, F.sha2(text, 256).alias("_hash"))
    rows = rows.agg(F.count(F.lit(1)).alias("_copies"), F.first(text).alias("_lamina_text"))
    rows = rows.select(*keys, "_hash", "_copies", "_lamina_text")
    parts = rows.mapInArrow(cut, f"{row}nth int, part string").repartition(*keys, "_hash", "nth")
    encoded = parts.mapInArrow(encode_parts, f"{row}nth int, part string, ids array<int>")
    together = encoded.groupBy(*keys, "_hash", "_copies").agg(F.collect_list(F.struct("nth", "part", "ids")).alias("parts"))
    joined = together.select(*keys, "_copies", "parts").mapInArrow(join, f"{kinds}`_copies` long, {tail}")
    copies = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return whole.unionByName(copies.drop("_copies", "_copy"))


def _decoded(ids, octets: list[bytes]) -> str:
    try:
        line = b"".join([octets[i] for i in ids])
    except IndexError:
        line = b"".join([octets[i] for i in ids if 0 <= i < len(octets)])
    return line.decode("utf-8", "replace")


def decode(encoded: DataFrame, vocabulary: str, keys: list[str], ids: str = "ids") -> DataFrame:
    """The key columns, ``ids``, and ``decoded``: the text of the ids, special tokens included.

    NULL ids give NULL, no ids the empty text. Ids beyond the vocabulary have no text. Bytes that are no
    text become replacement characters.
    """
    small_batches(encoded.sparkSession)

    def each(batches):
        import numpy as np
        import pyarrow as pa

        table = worker_cache("octets", vocabulary, lambda: token_octets(vocabulary))
        for batch in batches:
            lists = [one.values for one in batch.column(batch.num_columns - 1)]
            texts = [None if one is None else _decoded(np.asarray(one).tolist(), table) for one in lists]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*keys, "ids", "decoded"])

    chosen = encoded.select(*keys, F.col(ids).alias("ids"))
    return chosen.mapInArrow(each, f"{_kinds(encoded, keys)}ids array<int>, decoded string")
