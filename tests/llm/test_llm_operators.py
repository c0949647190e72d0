"""The training-data operators against brute force, round trips and held-out labels."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from plaudit.llm import bpe, components, fingerprints, mixing, near_dedup, neighbours, pii, quality, sharding, toxicity, warc
from plaudit.llm.queries import ORACLES, QUERIES, vocabulary_path

SMALL = "/root/testdata/sf0.001"
ROWS = "doc_id long, text string, source string, lang string, n_chars long, id long, node string, size string"
ODD = [
    (1, "One two three four five six.\nSeven eight.", "b", "en", 0, 5, "x", "y"),
    (1, "One two three four five six.\nSeven eight.", "b", "en", 0, 5, "x", "y"),
    (2, "ONE two  three four five six.\nSeven eight.", None, "en", None, None, None, None),
    (3, None, "a", None, 0, 5, "x", "y"),
    (4, "", None, None, 0, 5, "x", "y"),
    (5, "word", "b", "en", 0, 5, "x", "y"),
    (None, "lone é😀 <|endoftext|> text", "c", "en", 0, 5, "x", "y"),
    (7, "long " * 30_000, "c", "en", 0, 5, "x", "y"),
]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, ROWS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], ROWS)


def test_bpe_equals_library_and_decodes(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    rows = bpe.encode(odd, vocabulary_path(), decoded_column="back").collect()
    assert len(rows) == len(ODD)
    for row in rows:
        assert row["ids"] == library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["back"] == (row["text"] or "")
    assert bpe.decode(bpe.encode(none, vocabulary_path()), vocabulary_path()).count() == 0
    vocabulary = bpe.Vocabulary(open(vocabulary_path(), encoding="utf-8").read())
    letters = random.Random(1)
    texts = ["".join(letters.choice("ab \n\t'sé漢😀1_. 　\r") for _ in range(40)) for _ in range(500)] + ["ab" * 3000, " " * 300]
    assert vocabulary.encode(texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_fingerprints_recover_exact_differences(spark, odd, none):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    pairs = fingerprints.with_next(docs, "doc_id", "text").select(
        fingerprints.digests(F.col("text")).alias("a"), fingerprints.digests(F.col("next_text")).alias("b")
    )
    exact = F.size(F.array_except("a", "b")) + F.size(F.array_except("b", "a"))
    assert pairs.filter(fingerprints.differing(F.col("a"), F.col("b")) != exact).count() == 0
    texts = [(r["doc_id"], r["text"]) for r in docs.orderBy(F.desc("doc_id")).collect()]
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    for i, (doc_id, text) in enumerate(texts):
        third = len(text) // 3
        edited = text[: len(text) - third] + texts[(i + 1) % len(texts)][1][:third]
        assert got[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    rows = fingerprints.fingerprints(odd).collect()
    assert len(rows) == len(ODD) and len({r["fingerprint"] for r in rows if r["doc_id"] == 1}) == 1
    assert fingerprints.fingerprints(none).count() == 0


def likenesses(spark, pairs):
    table = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i long, a string, b string")
    keys = table.select("i", fingerprints.digests(F.col("a")).alias("a"), fingerprints.digests(F.col("b")).alias("b"))
    return [r["l"] for r in keys.select("i", fingerprints.likeness(F.col("a"), F.col("b")).alias("l")).orderBy("i").collect()]


def test_fingerprints_of_near_copies_around_512_characters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("char_length(text) >= 600")
    texts = [r["text"] for r in docs.select("text").orderBy("doc_id").limit(100).collect()]
    inside = likenesses(spark, [(t[:510], t[:511]) for t in texts])
    across = likenesses(spark, [(t[:511], t[:512]) for t in texts])
    assert np.median(across) > 0.4 and np.mean(across) > 0.9 * np.mean(inside)


def test_fingerprints_hand_on_the_digests_of_the_next_row(spark):
    words = ["Żółw", "né😀 слово", "文書です。", "ข้อความ ไทย", "a.b\nc", ""]
    docs = spark.createDataFrame([(i % 7 or None, " ".join(words[j % 6] for j in range(i, i * 3))) for i in range(20)], "doc_id long, text string")
    rows = fingerprints.with_next(docs, "doc_id", "text", {"own": fingerprints.digests})
    assert rows.count() == 20
    assert rows.filter(~F.col("own").eqNullSafe(fingerprints.digests(F.col("text")))).isEmpty()
    assert rows.filter(~F.col("next_own").eqNullSafe(fingerprints.digests(F.col("next_text")))).isEmpty()
    # Every code point is a letter or not as it is by the scripts alone.
    points = spark.range(0x110000).filter("id < 55296 OR id > 57343")
    letter = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    whole = rf"[\p{{L}}\p{{M}}&&[^{fingerprints.UNSPACED}]]"
    assert points.filter(letter.rlike(whole) != letter.rlike(fingerprints.LETTER)).isEmpty()


def test_fingerprints_line_up_again_after_an_inserted_word(spark):
    letters = random.Random(2)
    word = lambda: "".join(letters.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(letters.randint(2, 9)))
    lines = [" ".join(word() for _ in range(180)) for _ in range(20)]
    # Without spaces: one long run of letters, Chinese, base64.
    lines += ["".join(word() for _ in range(180)), "".join(chr(0x4E00 + letters.randrange(3000)) for _ in range(1000)),
              base64.b64encode(letters.randbytes(800)).decode()]
    assert min(likenesses(spark, [(line, line[:9] + " new " + line[9:]) for line in lines])) > 0.5
    # Every character counts, the mark of a cut included.
    pairs = [("a\0b", "a\0\2b"), ("a\0\1b", "a\0b"), ("ab", "a\0b"), ("a b", "a  b"), ("a. b", "a.b"), ("a", "a\n")]
    assert max(likenesses(spark, pairs)) < 1


def test_fingerprints_return_differences_and_follow_the_size(spark):
    words = lambda seed: " ".join(f"w{(i * i + seed) % 9973}." for i in range(3000))
    docs = spark.createDataFrame([(4, words(0)), (3, words(0)), (2, words(5)), (1, "short."), (0, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    assert rows[4]["fingerprint"] == rows[3]["fingerprint"] and rows[4]["near_next"] == 1
    cells = {i: len(r["fingerprint"].partition("-")[2]) // 16 for i, r in rows.items()}
    assert cells[1] == fingerprints.CELLS and cells[4] >= 1000
    text = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    keys = {}
    for i in text:
        third = len(text[i]) // 3
        keys[i] = (text[i], text[i][: len(text[i]) - third] + text[(i - 1) % 5][:third])
    table = spark.createDataFrame([(i, *pair) for i, pair in keys.items()], "i long, a string, b string")
    sets = table.select("i", fingerprints.digests(F.col("a")).alias("a"), fingerprints.digests(F.col("b")).alias("b")).collect()
    for i, a, b in sets:
        removed, added = rows[i]["removed"], rows[i]["added"]
        assert len(removed) + len(added) == len(set(removed) | set(added))
        assert set(removed) == set(a) - set(b) and set(added) == set(b) - set(a)
    assert len(rows[3]["removed"]) > 500 and len(rows[3]["added"]) > 500


def brute_components(rows, words, percent):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}
    find = lambda x: x if root[x] == x else find(root[x])
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, words, percent):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    base = [f"w{i}" for i in range(60)]
    edited = [(1000 + i, " ".join(base[:i] + ["new"] + base[i + 1 :])) for i in range(0, 60, 4)]
    docs = docs.unionByName(spark.createDataFrame(edited, "doc_id long, text string"))
    plan = near_dedup.NearDedup(words=words, percent=percent, block=8)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, plan=plan).collect()}
    assert got == brute_components([(r["doc_id"], r["text"]) for r in docs.collect()], words, percent)


def test_near_duplicates_meet_in_buckets_of_any_size(spark):
    """All texts share one bucket and nothing else; it is many times larger than a block."""
    plan = near_dedup.NearDedup(words=1, percent=80, rows=1, unseen=0.9, block=8)
    assert plan.bands == 1
    words = spark.createDataFrame([(i, f"w{i}") for i in range(600)], "doc_id long, text string")
    signed = near_dedup.signatures(words, "doc_id", "text", plan).select("id", "signature").collect()
    lowest = min(signed, key=lambda r: int(np.frombuffer(r["signature"], np.uint32)[0]))["id"]
    others = [f"w{i}" for i in range(600) if i != lowest]
    rows = []
    for g in range(30):
        text = " ".join([f"w{lowest}", *others[10 * g : 10 * g + 9]])
        rows += [(2 * g, text), (2 * g + 1, f"{text} {others[10 * g + 9]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, plan=plan).collect()}
    assert got == {i: i - i % 2 for i in range(60)}


def test_near_duplicates_odd_rows(odd, none):
    got = near_dedup.near_duplicates(odd).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(ODD) and by_id[2]["component_id"] == 1 and not by_id[2]["kept"]
    assert by_id[3]["n_shingles"] == 0 and by_id[3]["kept"] and by_id[4]["kept"] and by_id[7]["n_shingles"] == 1
    assert near_dedup.near_duplicates(none).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(None, 3), (7, 7)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_bayes_bound():
    assert near_dedup.least_agreements(32, 0.8, 1e-6) < 32 * 0.8
    assert near_dedup.least_agreements(256, 0.85, 1e-6) > 256 * 0.7


def test_sharding_balances_and_numbers(spark, odd, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").drop("n_chars").withColumn("size", F.lit("x"))
    rows = sharding.shard(docs).toPandas()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(s == len(texts[i].encode()) + 8 and c == zlib.crc32(texts[i].encode()) for i, s, c in zip(rows.doc_id, rows["size"], rows.text_crc32))
    assert set(rows["shard"]) == set(range(24))
    assert all(sorted(slots) == list(range(len(slots))) for _, slots in rows.groupby("shard").slot)
    size = rows.groupby("shard")["size"].sum()
    assert size.max() < 1.1 * size.min()
    # Only a group over an eighth of a shard may be cut.
    groups = rows.groupby("text_crc32").agg(shards=("shard", "nunique"), size=("size", "sum"), n=("size", "count"))
    share = np.maximum(groups["size"] / rows["size"].sum(), groups.n / len(rows))
    assert (groups.shards[share < 0.7 / (24 * 8)] == 1).all()
    assert sharding.shard(odd).count() == len(ODD) and sharding.shard(none).count() == 0
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    counts = sharding.shard(hot).groupBy("shard").count().toPandas()["count"]
    assert len(counts) == 24 and counts.max() < 200


def test_neighbours_recall_ties_and_odd_vectors(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    data = table.orderBy("vec_id").toPandas()
    x, ids = np.array(data.embedding.tolist(), float), data.vec_id.to_numpy()
    how = neighbours.Search(block=100, queries=10, leaf=16)
    got = neighbours.nearest(table, lambda i: i % 20 == 0, how=how).toPandas()
    hits = 0
    for query, found in got.groupby("query_id"):
        scores = x @ x[ids == query][0]
        scores[ids == query] = -np.inf
        hits += len(set(found.vec_id) & set(ids[np.argsort(-scores)[:20]]))
        assert list(found["rank"]) == list(range(1, 21)) and np.allclose(found.score, [scores[ids == v][0] for v in found.vec_id])
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()
    odd = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [0.0, 0.0]), (6, [None, 1.0]), (7, [float("inf"), 0.0]), (8, [1.0, 2.0, 3.0]), (1, [5.0, 0.0])]
    few = spark.createDataFrame(odd, "vec_id long, embedding array<double>")
    assert [(r["rank"], r["vec_id"]) for r in neighbours.nearest(few, lambda i: i == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert neighbours.nearest(few.limit(0), lambda i: i == 0).count() == 0


def test_mixing_equals_sql_and_handles_odd_rows(spark, odd, none):
    assert oracle.compare(QUERIES["op6_mixing"](spark, SMALL), oracle.connect(SMALL), ORACLES["op6_mixing"]) == []
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    for source in ("a", "b", "c", None):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
    assert mixing.mix(none).count() == 0


def test_pseudonyms_are_valid_linked_and_permuted(spark, odd, none):
    values = ["4111111111111111", "4111 1111 1111 1111", "+1 (743) 555-3824", "(743) 555-3824", "078-05-1120", "70.123.182.155",
              "2020-02-29", "2/29/2020", "29.02.2020", "abc.41@mail.example.com"]
    left = ["4111111111111112", "999.1.1.1", "2021-02-29", "000-12-3456", "12345", "no data"]
    docs = spark.createDataFrame([(i, f"x {v} y {v}.") for i, v in enumerate(values + left)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, "k", count_column="n").collect()}
    fresh = {}
    for i, value in enumerate(values):
        one, two = re.fullmatch(r"x (.*) y (.*)\.", got[i]["text"]).groups()
        assert one == two != value and got[i]["n"] == 2
        fresh[value] = one
    for i, value in enumerate(left, len(values)):
        assert got[i]["text"] == f"x {value} y {value}." and got[i]["n"] == 0
    digits = lambda v: re.sub(r"\D", "", v)
    assert digits(fresh[values[0]]) == digits(fresh[values[1]]) and digits(fresh[values[3]]) == digits(fresh[values[2]])[1:]
    luhn = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits(fresh[values[0]]))))
    assert luhn % 10 == 0
    y, m, d = fresh["2020-02-29"].split("-")
    assert fresh["2/29/2020"] == f"{m}/{d}/{y}" and fresh["29.02.2020"] == f"{d}.{m}.{y}"
    small = spark.range(35).select(pii.feistel(F.floor(F.col("id") / 7), F.col("id") % 7, F.lit(5), F.lit(7), F.lit("t"), "k").alias("p"))
    assert len({(r["p"]["l"], r["p"]["r"]) for r in small.collect()}) == 35
    assert [r["text"] for r in pii.pseudonymise(odd, "k").collect()] == [r[1] for r in ODD]
    assert pii.pseudonymise(none, "k").count() == 0


def test_cards_next_to_other_digits_are_replaced(spark):
    card, spaced = "4111111111111111", "4111 1111 1111 1111"
    texts = [card, spaced, f"{spaced} 12/25", f"{card} 123", f"order 12 {card}", f"1-{spaced}-22", "order 12 4111111111111112"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r["text"], r["n"]) for r in pii.pseudonymise(docs, "k", count_column="n").orderBy("doc_id").collect()]
    fresh, fresh_spaced = got[0][0], got[1][0]
    assert fresh != card and fresh_spaced != spaced
    assert got == [(t.replace(card, fresh).replace(spaced, fresh_spaced), int(t != texts[-1])) for t in texts]


def test_cards_in_long_runs_and_addresses_of_any_length_and_script(spark):
    card, dashed = "4111 1111 1111 1111", "4111-1111-1111-1111"
    texts = [card, dashed, f"ref 1234 {card}", f"2024 {dashed}", f"{card} {dashed} {card}", "1 2 3 4 " * 2000, "a@" + "b." * 100_000 + "com",
             "x" * 100_000 + "@y.de", "7 " * 50_000, "j\u00fcrgen.m@x.de", "\u044e\u0440\u0438\u0439@x.de"]
    docs = spark.createDataFrame([(i, t, "f", "n") for i, t in enumerate(texts)], "doc_id long, text string, found string, new string")
    rows = pii.pseudonymise(docs, "k", count_column="n").orderBy("doc_id").collect()
    got = [r["text"] for r in rows]
    assert [(r["found"], r["new"]) for r in rows] == [("f", "n")] * len(texts)
    assert got[2] == texts[2].replace(card, got[0]) and got[3] == texts[3].replace(dashed, got[1])
    assert [rows[i]["n"] for i in (0, 1, 2, 3)] == [1] * 4
    assert got[4] == f"{got[0]} {got[1]} {got[0]}" and card not in got[4]
    assert all(len(a) == len(b) for a, b in zip(got, texts))
    assert got[6] != texts[6] and got[6][1:] == texts[6][1:]
    assert got[9] != texts[9] and got[9][1] != "\u00fc" and got[9].endswith("@x.de")
    assert not set(got[10][:4]) & set("abcdefghijklmnopqrstuvwxyz") and got[10] != texts[10]


def test_clashing_names_and_orphan_revisits(spark, odd):
    clash = odd.withColumn("given", F.lit("x")).withColumn("given_", F.lit("y"))
    assert {(r["given"], r["given_"]) for r in bpe.encode(clash, vocabulary_path()).collect()} == {("x", "y")}
    model = toxicity.ToxicityModel((4, 5, 6), np.zeros(0, np.int64), np.zeros(0), 0.0)
    assert {(r["given"], r["given_"], r["score"]) for r in toxicity.score(clash, model).collect()} == {("x", "y", 0.5)}
    assert pii.pseudonymise(clash, "k", count_column="found").columns == [*clash.columns, "found"]
    orphan = spark.createDataFrame([(1, "u", "revisit", 9, "AAAA", None)], "page_id long, uri string, record_type string, refers_to long, payload_digest string, payload_bytes long")
    row = warc.pages_of(orphan).collect()
    assert [(r["page_id"], r["payload_bytes"], r["refers_to"]) for r in row] == [(1, None, 9)]


def test_pages_equal_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    first = {}
    for r in rows:
        first[r["html"] or ""] = min(first.get(r["html"] or "", r["page_id"]), r["page_id"])
    wanted = []
    for r in rows:
        text = r["html"] or ""
        digest = base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
        other = first[text] if first[text] != r["page_id"] else None
        wanted.append((r["page_id"], len(text.encode()), digest, "response" if other is None else "revisit", other))
    got = [tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in QUERIES["op9_warc"](spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got) == sorted(wanted)


def test_quality_is_right_on_held_out_rows(spark, odd, none):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op8_quality"](spark, folder).join(labels, "doc_id").filter("held_out").toPandas()
    assert ((rows.score >= 0.5) == (rows.quality == 1)).mean() > 0.95
    assert quality.quality(odd, labels.limit(0), toxicity.held_out).count() == len(ODD)
    assert quality.quality(none, labels, toxicity.held_out).count() == 0


def test_sparse_sites_shrink_toward_what_is_above(spark):
    rows = [("big", "p", 1)] * 90 + [("big", "q", 0)] * 10 + [("tiny", "p", 0)] + [("poor", "p", 0)] * 60 + [(None, None, 1)]
    hosts, paths, rate = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, label int"))
    host = {r["host"]: r["host_rate"] for r in hosts.collect()}
    assert host["poor"] < host["tiny"] < rate < host["big"] < 0.9 + 1e-9
    path = {(r["host"], r["path"]): r["path_rate"] for r in paths.collect()}
    assert path["big", "q"] < host["big"] < path["big", "p"]


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 20_000 + "\r\n\r\nWARC/1.1\r\n"
    pages = [(3, "http://a/", "same"), (1, "http://b/\nx", "same"), (2, None, big), (2, None, big), (5, "u", None), (6, "u", ""), (None, "u", "same"), (7, "u", "x")]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("first", F.lit(1))
    how = warc.Archive(segment_bytes=1000, chunk_bytes=333, file_records=3)
    warc.write_warc(table, str(tmp_path / "w"), how=how)
    records = warc.read_warc(spark, str(tmp_path / "w"))
    text = lambda p: None if p is None else bytes(p).decode()
    got = sorted([(str(r["page_id"]), r["record_type"], text(r["payload"])) for r in records.collect()], key=str)
    assert got == sorted([("3", "revisit", None), ("1", "response", "same"), ("2", "response", big), ("2", "response", big),
                          ("5", "response", ""), ("6", "revisit", None), ("None", "revisit", None), ("7", "response", "x")],
                         key=str)
    rows = {r["page_id"]: r for r in warc.pages_of(warc.lengths_of(records)).collect()}
    assert rows[3]["refers_to"] == 1 and rows[3]["payload_bytes"] == 4 and rows[2]["payload_bytes"] == len(big.encode())
    assert rows[6]["refers_to"] == 5 and rows[7]["payload_digest"] == base64.b32encode(hashlib.sha1(b"x").digest()).decode()
    with pytest.raises(ValueError):
        warc.reassemble([{"segment": 1, "total": None, "block": b"a", "origin": "o"}, {"segment": 3, "total": 9, "block": b"b", "origin": "o"}])


def test_toxicity_on_the_held_out_fold(spark, odd, none):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = QUERIES["op10_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out").toPandas()
    assert (rows[rows.toxic == 1].predicted == 1).mean() > 0.8 and (rows[rows.toxic == 0].predicted == 1).mean() < 0.01
    model = toxicity.train_on_labels(none, labels)
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(none, model).count() == 0


def test_toxicity_holds_some_rows_at_a_time(monkeypatch):
    import pyarrow as pa

    seen, texts = [], [f"text {i} " * (i % 5) for i in range(1300)]

    class Rows:
        """Takes the function that a frame would be given."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.run = run
            return self

    def watched(texts, *how, present=toxicity.present):
        seen.append(len(texts))
        return present(texts, *how)

    monkeypatch.setattr(toxicity, "present", watched)
    rows = Rows()
    slots = np.unique([s for _, _, found in toxicity.present(texts, (4,)) for s in found])
    toxicity._features(rows, (4,), slots)
    seen.clear()
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([i % 2 for i in range(1300)], pa.int32())], ["text", "label"])
    out = [r for part in rows.run(iter([batch])) for r in part.to_pylist()]
    assert max(seen) <= 512 and sum(seen) == 1300
    assert [r["label"] for r in out] == [i % 2 for i in range(1300)]
    alone = {i: sorted(found.tolist()) for i in range(1300) for _, _, found in toxicity.present(texts[i : i + 1], (4,))}
    assert all(sorted(r["slots"]) == alone[i] for i, r in enumerate(out))


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.train_on_labels(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    wanted = {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["score"] < 0.7}
    kept = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    assert {r["doc_id"] for r in kept.collect()} == wanted and kept.columns == corpus_pipeline.COLUMNS
    single = corpus_pipeline.drop_near_duplicates(spark, kept, SMALL)
    brute = brute_components([(r["doc_id"], r["text"]) for r in kept.collect()], 5, 80)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, (_, root) in brute.items() if root == i)
    mixed = corpus_pipeline.mix_sources(spark, single, SMALL)
    words = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    target = {r["source"]: int(r["target"]) for r in mixing.mix(single).collect()}
    assert words == {s: n for s, n in target.items() if n}
    last = corpus_pipeline.run(spark, SMALL)
    assert last.filter("not decodes").count() == 0 and last.count() >= mixed.count() * 0.9


def test_pipeline_stages_keep_rows_apart_that_share_an_id(spark, odd):
    clean = [(None, "first text without an id", "en", "a", 24), (None, "another one that has none", "en", "a", 25), (8, "eight words are enough to make this text", "en", "b", 40)]
    copies = [(1, "a text of its own under a number in use", "en", "b", 39), (9, "eight words are enough to make this text", "en", "b", 40), (None, "eight words are enough to make this text", "en", "b", 40)]
    docs = odd.select(*corpus_pipeline.COLUMNS).unionByName(spark.createDataFrame(clean + copies, "doc_id long, text string, lang string, source string, n_chars long"))
    assert corpus_pipeline.drop_toxic(spark, docs, SMALL).count() == docs.count()
    single = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    got = sorted(((r["doc_id"], r["text"]) for r in single.collect()), key=str)
    wanted = {(r[0], r[1]) for r in ODD if r[0] != 2} | {(r[0], r[1]) for r in clean + copies[:1]}
    assert got == sorted(wanted, key=str)
    assert sorted((str(r["doc_id"]), r["text"]) for r in corpus_pipeline.hide_personal_data(spark, single, SMALL).collect() if r["text"]) == sorted((str(i), x) for i, x in wanted if x)
    # Rows that share an id are taken by their own sizes.
    docs = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" and more"))))
    target = {r["source"]: int(r["target"]) for r in mixing.mix(docs).collect()}
    mixed = corpus_pipeline.mix_sources(spark, docs, SMALL)
    words = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert words == {s: n for s, n in target.items() if n}
    last = corpus_pipeline.encode_tokens(spark, mixed, SMALL)
    assert last.filter("not decodes").count() == 0 and last.count() == mixed.count()


def test_near_duplicates_and_neighbours_equal_brute_force_on_more_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    brute = brute_components([(r["doc_id"], r["text"]) for r in docs], 3, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op3_near_duplicates"](spark, folder).collect()}
    assert got == {i: tuple(v) for i, v in brute.items()}
    data = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    x, ids = np.array(data.embedding.tolist(), float), data.vec_id.to_numpy()
    wanted = set()
    for i in np.flatnonzero(ids % 20 == 0):
        scores = np.where(ids == ids[i], -np.inf, x @ x[i])
        wanted |= {(int(ids[i]), int(v)) for v in ids[np.lexsort((ids, -scores))[:20]]}
    found = {(r["query_id"], r["vec_id"]) for r in QUERIES["op5_neighbours"](spark, folder).collect()}
    assert len(found) == len(wanted) and len(found & wanted) >= 0.99 * len(wanted)
