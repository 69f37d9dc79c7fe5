"""Language, shards, secrets, templates and scores against plain Python."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings as run_settings, strategies as st
from pyspark.sql import functions as F

from lamina.llm import langid, lattice, queries, secrets, sharding, templates
from lamina.llm.common import id_bucket
from tests.llm.conftest import SCHEMA, SF


def slow_bundle(text, dimensions):
    letters = [0, *[ord(c) if c.isalpha() else 0 for c in text.lower()], 0]
    vectors = {p: langid._letter_vectors(np.array([p]), dimensions)[0].astype(float) for p in set(letters)}
    total = np.zeros(dimensions)
    for a, b, c in zip(letters, letters[1:], letters[2:]):
        if b:
            total += np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
    return total


def test_language_bundles(spark, monkeypatch):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est là", "fr"), (3, "the dog", "en"), (4, None, "en"), (5, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "CHARACTERS", 16)
    monkeypatch.setattr(langid, "TRIGRAMS", 4)
    profiles = langid.train(docs, dimensions=64)
    assert profiles.languages == ["en", "fr"]
    english = slow_bundle(rows[0][1], 64) + slow_bundle(rows[2][1], 64)
    assert np.allclose(profiles.vectors[0], english)
    found = {r["doc_id"]: r for r in langid.predict(docs, profiles, ["doc_id"]).collect()}
    own = slow_bundle("x", 64)
    cosines = [own @ np.array(v) / np.linalg.norm(own) / np.linalg.norm(v) for v in profiles.vectors]
    assert found[5]["lang_pred"] == profiles.languages[int(np.argmax(cosines))]
    assert found[5]["score"] == pytest.approx(max(0, *cosines))
    assert (found[4]["lang_pred"], found[4]["score"]) == ("und", 0)


@pytest.mark.parametrize("cells", [1, 20, 1 << 24])
def test_blocks_of_any_size_count_the_same(cells):
    """Halved blocks cover every text once, in their order, with the bundles of the whole."""
    texts = ["", "the cat", "12", "日本語のテキスト", "le chat", "x", "", "the cat"]
    blocks = list(langid._counted(texts, cells))
    assert cells > 20 or len(blocks) > 1
    assert [b for b, *_ in blocks] == np.cumsum([0, *[len(c) for *_, c in blocks[:-1]]]).tolist()
    assert sum(len(c) for *_, c in blocks) == len(texts)
    bundles = np.concatenate([langid._bundled(alphabet, codes, counts, 64) for _, alphabet, codes, _, counts in blocks])
    assert np.allclose(bundles, [slow_bundle(t, 64) for t in texts])
    letters = np.concatenate([n for *_, n, _ in blocks])
    assert letters.tolist() == [sum(c.isalpha() for c in t) for t in texts]


@pytest.mark.parametrize("size", [1, 2, 5, 16, 1 << 20])
def test_pieces_of_long_texts_add_up(monkeypatch, size):
    """Whatever the length of the pieces, a text's blocks follow each other and add up to the whole text's."""
    monkeypatch.setattr(langid, "CHARACTERS", size)
    texts = ["le chat est là", "", "  x ", "İ of two letters", "日本語のテキスト 😀a", "1", "ab"]
    bundles, letters, order = np.zeros((len(texts), 64)), np.zeros(len(texts), int), []
    for begin, alphabet, codes, each, counts in langid._counted(texts):
        bundles[begin : begin + len(counts)] += langid._bundled(alphabet, codes, counts, 64)
        letters[begin : begin + len(counts)] += each
        order.append(begin)
    assert np.allclose(bundles, [slow_bundle(t, 64) for t in texts])
    assert letters.tolist() == [sum(c.isalpha() for c in t.lower()) for t in texts]
    assert order == sorted(order)


def test_every_letter_has_a_vector_of_its_own():
    letters = np.array([p for p in range(langid.POINTS) if chr(p).isalpha() and (p < 0x3000 or 0x4E00 <= p < 0x6000)])
    vectors = langid._letter_vectors(letters, 256)
    assert set(np.unique(vectors)) == {-1, 1} and len(np.unique(vectors, axis=0)) == len(letters) > 10_000
    some = vectors[:: len(letters) // 500].astype(float)
    cosines = some @ some.T / 256 - np.eye(len(some))
    assert abs(cosines).max() < 0.45 and abs(vectors.mean()) < 0.01
    assert langid._letter_vectors(letters[:3], 100).shape == (3, 100)


def test_codes_are_numbered_alike_by_table_and_by_sorting():
    codes = np.array([7, 3, 7, 0, 999, 3])
    for most in (1000, langid.CELLS + 1):
        distinct, place = langid._distinct(codes, most)
        assert distinct.tolist() == [0, 3, 7, 999] and distinct[place].tolist() == codes.tolist()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op1_language_id(spark, "/root/testdata/sf0.01").filter("held_out")
    judged = found.join(docs.filter("lang is not null"), "doc_id").select((F.col("lang_pred") == F.col("lang")).cast("int").alias("ok"))
    assert judged.agg(F.avg("ok")).first()[0] >= 0.97


def test_odd_languages(odd, nothing):
    profiles = langid.train(odd)
    found = langid.predict(odd, profiles, ["doc_id", "text"]).collect()
    assert len(found) == odd.count()
    for r in found:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
        assert 0 <= r["score"] <= 1
    kept = langid.keep_identified(odd, profiles)
    assert kept.columns == odd.columns and kept.count() == sum(r["lang_pred"] != "und" for r in found)
    none = langid.train(nothing)
    assert none.languages == []
    assert {r["lang_pred"] for r in langid.predict(odd, none, ["doc_id"]).collect()} == {"und"}
    assert langid.predict(nothing, profiles, ["doc_id"]).count() == 0


def check_shards(rows, docs, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in docs
    )
    for shard in {r["shard"] for r in rows}:
        assert 0 <= shard < shards
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    assert all(r["grown_shard"] in (r["shard"], shards) for r in rows)
    of = {}
    assert all(of.setdefault(r["doc_id"], r["shard"]) == r["shard"] for r in rows)


def test_shards(spark, documents, odd, nothing, monkeypatch):
    check_shards(sharding.shard_rows(documents, [1.0] * 40).collect(), documents.collect(), 40)
    monkeypatch.setattr(sharding, "COPIES", 2)
    many = odd.unionByName(odd.filter("doc_id = 5")).unionByName(odd)
    check_shards(sharding.shard_rows(many, [1.0] * 7).collect(), many.collect(), 7)
    assert sharding.shard_rows(nothing, [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_of(["doc_id"], [1.0, 0.0])


def test_weights_and_growth(spark):
    ids = spark.range(40_000).withColumn("text", F.lit("x"))
    weights = [1.0, 2.0, 5.0]
    found = sharding.shard_rows(ids, weights, doc_id="id", grown=[*weights, 2.0])
    shares = Counter(r["shard"] for r in found.select("shard").collect())
    assert [round(shares[s] / 40_000, 2) for s in range(3)] == pytest.approx([1 / 8, 2 / 8, 5 / 8], abs=0.02)
    moved = found.filter("grown_shard <> shard")
    assert {r[0] for r in moved.select("grown_shard").distinct().collect()} == {3}
    assert moved.count() == pytest.approx(8000, rel=0.05)
    again = sharding.shard_rows(ids.repartition(5), weights, doc_id="id").select("doc_id", "shard", "slot")
    assert again.exceptAll(found.select("doc_id", "shard", "slot")).count() == 0


def test_sharding_is_native(documents):
    plan = sharding.shard_rows(documents, [1.0] * 40)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def slow_spans(text, rules=secrets.RULES):
    found = []
    for place, rule in enumerate(rules):
        for m in rule.compiled().finditer(text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), place, m.end()))
    return sorted(found)


FRAGMENTS = ["pass", "word", "password", "PASSWD", "Secret", "token", "api", "_", "key", "apikey", "'", '"', " ", ":", "=", "AKIA", "akia", "ABCDEFGH01234567", "0123456789abcdef", "deadbeef", "é", "ſecret", "toKen", "\n", "x", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "ghp_", "a" * 36, "xoxb-", "eyJ", ".", "0" * 12]


@run_settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(FRAGMENTS), max_size=14).map("".join), min_size=1, max_size=6))
def test_index_finds_what_a_full_scan_finds(texts):
    assert SCAN(texts) == [slow_spans(t) for t in texts]


SCAN = secrets.scanner()


@pytest.mark.parametrize(
    ("pattern", "expected"),
    [
        (r"[0-9a-f]+", secrets.ALL),
        (r"AKIA[A-Z0-9]+", ("and", (("has", b"aki"), ("has", b"kia")))),
        (r"(?:foo|bar)x*", ("or", (("has", b"bar"), ("has", b"foo")))),
        (r"ab?c", secrets.ALL),
        (r"(?:abc)?", secrets.ALL),
        (r"(?:abcd)+", ("and", (("has", b"abc"), ("has", b"bcd")))),
    ],
)
def test_trigram_queries(pattern, expected):
    assert secrets.trigram_query(pattern) == expected


def test_rules_without_trigrams_scan_all():
    queries_ = {rule.kind: secrets.trigram_query(rule.pattern, rule.any_case) for rule in secrets.RULES}
    assert [kind for kind, query in queries_.items() if query == secrets.ALL] == ["hex"]


def test_long_runs_are_read_once():
    token = "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12
    texts = ["eyJ" * 300_000, f"x={token} end", "-----BEGIN " + "A " * 300_000, "token" * 100_000, "xox" * 300_000]
    web = secrets.KINDS.index("web_token")
    assert secrets.scanner()(texts) == [[], [(2, web, 2 + len(token))], [], [], []]


TOKEN = "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12


@run_settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["eyJ", "e", "ey", ".eyJ", ".", "a" * 10, "b" * 9, "-", "_", "%20", " ", "\\n", TOKEN]), max_size=14).map("".join))
def test_web_tokens_are_those_of_the_plain_pattern(text):
    assert SCAN([text]) == [slow_spans(text)]


@pytest.mark.parametrize("size", [1, 3, 7, 64])
def test_slices_of_long_texts_lose_no_trigram(monkeypatch, size):
    """A trigram that lies across two slices is found, so the spans are those of a text in one slice."""
    texts = ["", "ab", "x" * 90 + " password = abcdef12 é AKIA" + "Q" * 20 + " token:" + "z" * 9, "é" * 40 + "api_key='0123456'", "0" * 30]
    whole = secrets.scanner()(texts)
    monkeypatch.setattr(secrets, "BLOCK_BYTES", size)
    assert secrets.scanner()(texts) == whole and [len(s) for s in whole][:2] == [0, 0] and all(whole[2:])


@pytest.mark.parametrize("before", ["Bearer%20", "\\n", "session_", "eyJ", "x-", ""])
def test_web_tokens_after_any_letter(before):
    web = secrets.KINDS.index("web_token")
    begin = 0 if before == "eyJ" else len(before)
    assert SCAN([f"{before}{TOKEN} end"]) == [[(begin, web, len(before + TOKEN))]]


BODY = ["MIIEowIBAAKCAQEA" + "q7+/Zx" * 8, "b64/Line" * 8, "Qx9=="]
BEGIN, END = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"


@pytest.mark.parametrize(
    ("text", "left"),
    [
        ("\n".join(["a", BEGIN, *BODY, END, "rest of it"]), "a\n[secret]\nrest of it"),
        ("\n".join(["a", BEGIN, *BODY, "", "The rest of it"]), "a\n[secret]\n\nThe rest of it"),
        (" ".join(["a", BEGIN, *BODY, "The rest of it"]), "a [secret] The rest of it"),
        ('{"k": "' + "\\n".join([BEGIN, *BODY, END]) + '\\n"}', '{"k": "[secret]\\n"}'),
        ('{"k": "' + "\\n".join([BEGIN, *BODY]) + '", "n": 1}', '{"k": "[secret]", "n": 1}'),
        ("\n".join([BEGIN, "Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A", "", *BODY, BEGIN, *BODY, END, "x"]), "[secret]\n[secret]\nx"),
        ("\n".join(["-----BEGIN PGP PRIVATE KEY BLOCK-----", "Version: 1", "", *BODY, "=abcd", "-----END PGP PRIVATE KEY BLOCK-----", "x"]), "[secret]\nx"),
        (f"the line {BEGIN} is a header", "the line [secret] is a header"),
    ],
)
def test_private_keys_go_with_their_body(spark, text, left):
    found = secrets.redact_secrets(spark.createDataFrame([(text,)], "text string")).collect()[0]["text"]
    assert found == left and not any(line in found for line in BODY)


def test_many_private_keys_are_read_once():
    for text in (f"{BEGIN} a-b " * 20_000, "-----BEGIN A " * 60_000, f"{BEGIN}\n" + "-" * 600_000, f"{BEGIN}\n" + "ab\n" * 300_000, f"{BEGIN} " + ("x" * 23 + " ") * 30_000, f"{BEGIN}\n" + "\\" * 600_000):
        assert len(SCAN([text])[0]) == (20_000 if "a-b" in text else text.count(BEGIN))


def test_secrets_of_documents(spark, odd, nothing):
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    total = 0
    for r in queries.op6_secret_scan(spark, folder).collect():
        spans = slow_spans(texts[r["doc_id"]])
        names = [(secrets.KINDS[p], f"{secrets.KINDS[p]}:{a}:{b}") for a, p, b in spans]
        base = ("assign", "access", "hex")
        assert [r[f"n_{k}"] for k in base] == [sum(n == k for n, _ in names) for k in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(x for n, x in names if n in base).encode()).hexdigest()
        assert r["spans"] == ",".join(x for _, x in names)
        total += len(spans)
    assert total > 0
    found = secrets.secret_spans(odd)
    assert found.count() == odd.count() and all(r["spans"] == [] for r in found.collect())
    assert secrets.secret_spans(nothing).count() == 0


def test_redaction(spark, odd):
    key = "AKIA" + "Q" * 16
    rows = [(1, f"é token = {key} end", None, None, 0), (2, "clean", None, None, 5), (3, None, None, None, None)]
    found = secrets.redact_secrets(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(1, "é [secret] end", None, None, 14), rows[1], rows[2]]
    same = secrets.redact_secrets(odd)
    assert same.columns == odd.columns and sorted(map(repr, same.collect())) == sorted(map(repr, odd.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast("long")).collect()))


def pairs_of(spark, docs, items, **options):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in templates.contaminated(docs, items, ["doc_id"], **options).collect()}


QUESTION = "On Monday a farmer called Anna Miller sells 12 apples for 3 dollars each and buys 12 pears. How much money does Anna get in total?"


def test_templates_catch_other_parameters(spark):
    other = QUESTION.replace("Anna", "Peter").replace("Miller", "Jones").replace("12", "40").replace("3 dollars", "7 euros").replace("Monday", "Friday")
    broken = other.replace("40 pears", "41 pears")
    docs = ["some words before. " + QUESTION + " some words after", other, broken, "an unrelated text about farmers and apples", None, ""]
    found = pairs_of(spark, docs, [QUESTION, "too short", None])
    assert set(found) == {(0, 0), (1, 0)}
    assert (found[0, 0]["reparameterised"], found[1, 0]["reparameterised"]) == (False, True)


def test_one_alignment_must_be_consistent(spark):
    """Two copies with different values do not contradict each other; part of an item is not the item."""
    other = QUESTION.replace("Anna", "Eva").replace("12", "5")
    words = QUESTION.split()
    found = pairs_of(spark, [QUESTION + "\n" + other, " ".join(words[: len(words) // 2])], [QUESTION])
    assert set(found) == {(0, 0)}


@pytest.mark.parametrize("similarity", [0.3, 0.8, 1.0])
def test_items_that_share_most_windows(spark, similarity):
    """Against every document compared with every item: many items begin alike, and parts of them are in documents."""
    opening = "please read the whole question with care and then choose the one best answer from the list below"
    tails = ["which metal melts first", "what colour does the clear sky have at noon", "who wrote it", "", "who wrote it"]
    items = [f"{opening} {t}" for t in tails]
    words = items[1].split()
    docs = [opening, *items, " ".join(words[2:]), " ".join(words[:-3]), " ".join(words[9:]), f"{items[0]} {items[1]}"]
    found = pairs_of(spark, docs, items, similarity=similarity)

    def shingles(text):
        own = text.split()
        return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}

    expected = {
        (d, i): len(shingles(doc) & shingles(item))
        for d, doc in enumerate(docs)
        for i, item in enumerate(items)
        if len(shingles(doc) & shingles(item)) >= similarity * len(shingles(item))
    }
    assert {pair: r["matched"] for pair, r in found.items()} == expected


def test_items_and_documents_without_an_id(spark):
    other = "a second item without an id that must be seen as one of its own"
    items = spark.createDataFrame([(None, QUESTION), (None, other), (7, other)], "item_id long, text string")
    docs = spark.createDataFrame([(None, other), (1, QUESTION), (None, "clean words that are no item at all")], "doc_id long, text string")
    found = templates.contaminated(docs, items, ["doc_id"]).select("doc_id", "item_id", "similarity").collect()
    assert sorted(map(tuple, found), key=repr) == [(1, None, 1.0), (None, 7, 1.0), (None, None, 1.0)]
    assert [r["text"][:5] for r in templates.drop_contaminated(docs, items).collect()] == ["clean"]


def test_a_contradiction_costs_its_own_windows(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    words[5], words[25] = "Tom", "Tom"
    near = [*words]
    near[25] = "Tim"
    both = [*near]
    both[5] = "Tim"
    docs = [" ".join(near), " ".join(both), QUESTION.replace("3 dollars", "12 dollars"), QUESTION.replace("12 pears", "13 pears")]
    found = pairs_of(spark, docs, [" ".join(words), QUESTION])
    assert {pair: (r["matched"], r["n_windows"], r["reparameterised"]) for pair, r in found.items()} == {
        (0, 0): (31, 36, False), (1, 0): (36, 36, True), (2, 1): (22, 22, True)
    }
    sums = ["what is the sum of 3 + 4 if both of the numbers are whole", "what is the sum of 5 + 5 if both of the numbers are whole"]
    assert set(pairs_of(spark, sums[1:], sums[:1])) == {(0, 0)}


def test_copies_with_other_case_lines_and_marks(spark):
    words = QUESTION.split()
    wrapped = "\n".join(" ".join(words[i : i + 5]) for i in range(0, len(words), 5))
    marks = QUESTION.replace("called ", "called: ").replace("pears.", "pears").replace("sells", "sells.")
    other = QUESTION.replace("Anna", "Eva").replace("12", "5")
    docs = [QUESTION.lower(), QUESTION.upper(), wrapped, marks, wrapped.lower(), other, " ".join(words[: len(words) // 2]).lower()]
    found = pairs_of(spark, docs, [QUESTION])
    assert {pair: (r["similarity"], r["reparameterised"]) for pair, r in found.items()} == {(d, 0): (1.0, d == 5) for d in range(6)}
    assert set(pairs_of(spark, [QUESTION], [QUESTION.lower(), wrapped, QUESTION.upper()])) == {(0, 0), (0, 1), (0, 2)}


def test_scripts_without_blanks(spark):
    """Items in Chinese, Japanese and Thai are found inside longer sentences, with other punctuation and line breaks."""
    items = ["农夫有十二只羊，卖了三只以后还剩下多少只羊？", "東京から大阪まで新幹線でどのくらいかかりますか。", "ชาวนามีแกะสิบสองตัวขายไปสามตัวเหลือกี่ตัว"]
    texts = [
        f"前面的话。{items[0]}后面还有别的话",
        "说：" + items[0].replace("，", "\n").replace("？", "!"),
        f"質問です、{items[1]}と聞かれた",
        f"เขาถามว่า{items[2]}แล้วก็เดินไป",
        "农夫昨天去了城里，买了很多东西回来给家里的孩子们。",
        "plain words that hold none of the items above",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = templates.contaminated(docs, asked, ["doc_id"]).select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found)) == [(0, 0), (1, 0), (2, 1), (3, 2)]


def test_remembered_words_are_short(monkeypatch):
    monkeypatch.setattr(templates, "LONGEST", 8)
    canonical = templates.Canonicaliser()
    for _ in range(3):
        canonical.block(["short " + "long" * 10 + " words"])
    assert set(canonical.places) == {"short", "words"} and canonical.once <= {"short", "words"}


def test_short_and_numeric_items(spark):
    items = ["Capital of France?", "2 4 8 16 32 64", "Anna Berta Clara Dora Emil Fritz", "Paris", "continue the row 1 2 3 4 5 6 7 8 9 with care and give the next number"]
    docs = [
        "what is the capital of France, and why. The capital of France",
        "the capital of all of France",
        "powers: 2, 4, 8, 16, 32, 64 and so on",
        "powers: 2, 4, 8, 16, 33, 64 and so on",
        "they ask Anna, Berta, Clara, Dora, Emil, Fritz",
        "they ask Georg, Hans, Ida, Jan, Karl, Lena",
        "paris",
        items[4].replace("1 2 3 4 5 6 7 8 9", "10 20 30 40 50 60 70 80 90"),
        "of France capital",
    ]
    found = pairs_of(spark, docs, [*items, "", " "])
    assert set(found) == {(0, 0), (2, 1), (4, 2), (6, 3), (7, 4)}
    assert found[0, 0]["similarity"] == found[2, 1]["similarity"] == 1 and found[7, 4]["reparameterised"]


def test_texts_that_share_an_id(spark, tmp_path):
    """Concatenated benchmarks number from 0 each, and documents repeat an id or have none."""
    other = "a second item with the same id that must be seen as one of its own by every document"
    items = spark.createDataFrame([(0, QUESTION), (0, other), (1, other)], "item_id long, text string")
    changed = QUESTION.replace("Anna", "Eva")
    docs = [(None, QUESTION), (None, changed), (5, other), (5, QUESTION.replace("12", "7")), (5, "clean words that are no item at all")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.op7_decontamination(spark, str(tmp_path)).select("doc_id", "item_id", "similarity", "reparameterised").collect()
    expected = [(None, 0, 1.0, False), (None, 0, 1.0, True), (5, 0, 1.0, False), (5, 1, 1.0, False), (5, 0, 1.0, True)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert templates.drop_contaminated(docs, items).count() == 1


def test_planted_benchmark_passages(spark):
    """What contains an item word for word is found, and what shares less than half of its windows is not."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, SF).collect()}

    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    own = {d: shingles(t) for d, t in docs.items()}
    for item, text in items.items():
        asked = shingles(text)
        for doc in docs:
            share = len(asked & own[doc]) / len(asked)
            if share >= 0.9:
                assert (doc, item) in found
            if share < 0.5:
                assert (doc, item) not in found
    assert found


def test_odd_documents_hold_nothing(spark, odd, nothing):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert templates.contaminated(odd, items, ["doc_id"]).count() == 0
    kept = templates.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert templates.drop_contaminated(nothing, items).count() == 0
    assert templates.drop_contaminated(odd, items.limit(0)).count() == odd.count()
    same = spark.createDataFrame([(None, QUESTION, 1), (None, QUESTION, 2), (None, "clean words that are no item at all", 3)], "doc_id long, text string, h int")
    item = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    assert [r["h"] for r in templates.drop_contaminated(same, item).collect()] == [3]


def slow_word(scores, word):
    """The sum over all segmentations, written out."""
    line = lattice.BLANK + word
    total = 0.0
    for cuts in itertools.product((0, 1), repeat=len(line) - 1):
        parts, begin = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(line[begin:i])
                begin = i
        parts.append(line[begin:])
        options = []
        for part in parts:
            ways = [math.exp(scores[part])] if part in scores else []
            if len(part) == 1:
                ways.append(math.exp(sum(scores[b] for b in part.encode())))
            options.append(sum(ways))
        total += math.prod(options)
    return math.log10(total)


def test_forward_recursion():
    scores = {b: math.log(0.001 * (b + 1) / 256) for b in range(256)}
    scores |= {p: math.log(0.01 * (i + 1)) for i, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "aba", "é", "▁ab"])}
    graph = lattice.Lattice(scores)
    for word in ("a", "ab", "abab", "éa", "x", "abba🙂", "▁a", "bbbbbb"):
        assert graph.word(word) == pytest.approx(slow_word(scores, word), rel=1e-12)
    assert math.isfinite(graph.word("ab" * 20_000))


def test_long_words_need_little_memory():
    import tracemalloc

    graph = lattice.Lattice({b: -5.0 for b in range(256)} | {"abc": -1.0})
    tracemalloc.start()
    graph.word("abc" * 100_000)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 20 * 300_000


@pytest.mark.parametrize("frequent", [1, 50, 10**6])
def test_scores(spark, documents, odd, frequent):
    from sentencepiece import SentencePieceProcessor

    vocabulary = queries._vocabulary("piece_bpe_32k.model")
    docs = documents.unionByName(odd.select(*documents.columns)) if frequent == 50 else odd
    learn = id_bucket("doc_id", 10) != 0
    found = lattice.score_texts(docs, learn, vocabulary, frequent=frequent).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    counts, ends = Counter(), 0
    for doc, text in rows:
        if not held(doc):
            counts.update((text or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    model = SentencePieceProcessor(model_file=vocabulary)
    pieces = Counter()
    for word, times in counts.items():
        for p in model.encode(word.decode()):
            pieces[p] += times
    scores, end = lattice.piece_scores(vocabulary, pieces, ends)
    assert sum(math.exp(s) for s in scores.values()) + 10**end == pytest.approx(1, abs=1e-3)
    graph = lattice.Lattice(scores)
    expected = []
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(counts[w] for w in words), ends])
        known = sum(counts[w] > 0 for w in words) + 1
        expected.append((doc, held(doc), len(words) + 1, known, n, base, sum(graph.word(w.decode()) for w in words) + end))
    key = lambda r: (repr(r[0]), r[2], r[5])
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_long_words_are_not_handed_out(spark):
    rows = [("short", 5), ("x" * 64, 5), ("x" * 65, 5), ("é" * 33, 5), ("", 1)]
    scored = spark.createDataFrame(rows, "word string, n long")
    assert {r["word"] for r in lattice.handed_out(scored, scored, 100).collect()} == {"short", "x" * 64, ""}


def test_nothing_to_score(spark, nothing, odd):
    vocabulary = queries._vocabulary("piece_bpe_32k.model")
    assert lattice.score_texts(nothing, F.lit(True), vocabulary).count() == 0
    untaught = lattice.score_texts(odd, F.lit(False), vocabulary).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in untaught} == {(0, 0)}
    assert all(math.isfinite(r["score"]) for r in untaught)
