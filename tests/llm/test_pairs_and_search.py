"""Alignment, vector near-duplicates and lexical search against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from plaudit.llm import alignment, lexical, vector_dedup
from plaudit.llm.bpe import byte_letters
from plaudit.llm.queries import ORACLES, QUERIES, vocabulary_path

SMALL = "/root/testdata/sf0.001"
PIECES = "piece_bpe_32k.model"
TEXTS = [(1, "One two, three."), (1, "One two, three."), (2, None), (3, ""), (None, "lone é\U0001f600 text"), (5, "a▁b"), (6, "<|endoftext|> <s> <0x41>"),
         (7, "\x00 \t\n\n  é漢"), (8, "ab" * 40_000), (9, " " * 3_000), (10, "﻿​ x\r\n"), (11, " lead  and trail ")]


# -- alignment -----------------------------------------------------------------------


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(PIECES))
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    known = {i: bytes(byte_of.get(c, 0) for c in t) for t, i in library.get_vocab().items()}
    found, counts = [], Counter()
    for text in rows:
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        a_bytes = [known[i] for i in a]
        b_bytes = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode() if text else b""
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            found.append(None)
            continue
        a_of = [i for i, x in enumerate(a_bytes) for _ in x]
        b_of = [i for i, x in enumerate(b_bytes) for _ in x]
        links = sorted(set(zip(a_of, b_of)))
        ends = [n for n in range(1, len(whole) + 1) if n == len(whole) or (a_of[n] != a_of[n - 1] and b_of[n] != b_of[n - 1])]
        groups, x, y = [], 0, 0
        for end in ends:
            x2, y2 = a_of[end - 1] + 1, b_of[end - 1] + 1
            groups.append((a[x:x2], b[y:y2]))
            x, y = x2, y2
        found.append((a, b, links, groups))
        counts.update((a[i], b[j]) for i, j in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for one in found:
        if one is None:
            out.append((0,) * 8 + ("",))
            continue
        a, b, links, groups = one
        n = [counts[a[i], b[j]] for i, j in links]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(len(x) * len(y) for x, y in groups),
                    sum(k == best[b[j]] for k, (_, j) in zip(n, links)), sum(n), 0, hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_shared_group_links", "n_best", "count_sum"]


@pytest.mark.parametrize("chunk_bytes", [200, 2 << 20])
def test_alignment_equals_brute_force(spark, chunk_bytes):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("doc_id", F.col("doc_id") - 100)
    rows = [(r["doc_id"], r["text"]) for r in docs.union(odd).collect()]
    wanted = sorted(((k, *w[:7], w[8]) for (k, _), w in zip(rows, brute_alignment([t for _, t in rows]))), key=str)
    table = docs.union(odd).withColumn("ids", F.lit(1)).withColumn("chunk", F.lit("x"))
    got = alignment.alignment(table, vocabulary_path(), vocabulary_path(PIECES), chunk_bytes=chunk_bytes).collect()
    assert sorted(((r["doc_id"], *[r[c] for c in COLUMNS], r["groups_sha256"]) for r in got), key=str) == wanted


def test_token_links_are_those_counted(spark):
    odd = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(TEXTS)], "doc_id long, text string")
    counted = {r["doc_id"]: r for r in alignment.alignment(odd, vocabulary_path(), vocabulary_path(PIECES)).collect()}
    for shared, column in ((False, "n_links"), (True, "n_shared_group_links")):
        links = alignment.token_links(odd, vocabulary_path(), vocabulary_path(PIECES), shared)
        n = {r["doc_id"]: r["count"] for r in links.groupBy("doc_id").count().collect()}
        assert n == {i: r[column] for i, r in counted.items() if r[column]}
    none = alignment.alignment(odd.limit(0), vocabulary_path(), vocabulary_path(PIECES))
    assert none.count() == 0 and alignment.token_links(odd.limit(0), vocabulary_path(), vocabulary_path(PIECES)).count() == 0


def test_csr_products_equal_dense_ones():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = (rng.integers(0, 2, (rng.integers(1, 8), 6)) for _ in range(2))
        x, y = (alignment.Csr(np.r_[0, m.sum(1).cumsum()], np.nonzero(m)[1], 6) for m in (a, b))
        row, column, value = x.times(y.transposed())
        dense = np.zeros((len(a), len(b)), int)
        dense[row, column] = value
        assert (dense == a @ b.T).all() and (value > 0).all()


# -- vectors -------------------------------------------------------------------------


def brute_vectors(rows, least=0.98):
    """n_links and component per row; rows are (id, vector, label)."""
    usable = [v is not None and label is not None and any(v) and all(x is not None and math.isfinite(x) for x in v) for _, v, label in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= least:
                    links[i] += 1
                    links[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            smallest[find(i)] = min(smallest.get(find(i), key), key)
    return sorted(((key, links[i], smallest.get(find(i))) for i, (key, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("window, block", [(512, 2048), (4, 8), (1, 3)])
def test_vector_links_equal_brute_force(spark, window, block):
    rng = np.random.default_rng(4)
    rows = []
    for label in (0, 1):
        centres = rng.standard_normal((12, 8))
        # One group of near copies is much larger than a window.
        for group, size in enumerate([60, 9, 4, *[1] * 9]):
            rows += [(len(rows) + i, (centres[group] + 0.04 * rng.standard_normal(8)).tolist(), label) for i in range(size)]
    rows += [(rows[0][0], rows[0][1], 0), (900, rows[0][1], 0), (901, [2 * x for x in rows[0][1]], 0), (902, rows[0][1], None), (903, None, 0),
             (904, [0.0] * 8, 0), (905, [float("nan")] * 8, 0), (906, [float("inf")] + [1.0] * 7, 0), (907, [None, 1.0], 0), (908, [], 0),
             (909, [1.0, 2.0], 0), (910, [1.0, 2.0], 0), (None, [1.0, 2.01], 0), (None, [5.0], 7)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("class", F.lit("c"))
    plan = vector_dedup.SortedPasses(window=window, block=block, unseen=1e-9)
    got = vector_dedup.near_duplicate_vectors(table, how=plan).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == brute_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_vector_query_equals_sql_and_handles_an_empty_table(spark):
    folder = "/root/testdata/sf0.01"
    assert oracle.compare(QUERIES["op12_vector_dedup"](spark, folder), oracle.connect(folder), ORACLES["op12_vector_dedup"]) == []
    assert vector_dedup.near_duplicate_vectors(spark.read.parquet(f"{folder}/embeddings.parquet").limit(0)).count() == 0


def test_passes_follow_the_size_of_a_label():
    how = vector_dedup.SortedPasses()
    assert how.passes(500) == 1 and how.bits(500) == 0
    for size in (5_000, 10**6, 10**9):
        together = (1 - math.acos(0.98) / math.pi) ** how.bits(size)
        assert (1 - together) ** how.passes(size) <= how.unseen and size / 2 ** how.bits(size) <= how.window


# -- search --------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute_search(docs, items, nearest):
    held = [Counter(terms_of(t)) for _, t in docs]
    n_docs, n_terms = sum(bool(h) for h in held), sum(sum(h.values()) for h in held)
    df = Counter(t for h in held for t in h)
    out = []
    for item, text in items:
        scores = []
        for (doc, _), h in zip(docs, held):
            n = sum(h.values())
            score = 0
            for t in set(terms_of(text)) & h.keys():
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * h[t] // (1000 * h[t] + 20 * (100 - 50 + 50 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:nearest], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_bytes, nearest, item_terms", [(1 << 25, 50, 100_000), (2_000, 3, 10), (20_000, 10, 1)])
def test_search_equals_brute_force(spark, monkeypatch, shard_bytes, nearest, item_terms):
    monkeypatch.setattr(lexical, "ITEM_TERMS", item_terms)
    rng = random.Random(shard_bytes)
    words = [f"w{i}" for i in range(60)] + ["Été", "漢字", "x1"]
    draw = lambda n: " ".join(words[min(int(rng.expovariate(0.08)), len(words) - 1)] for _ in range(n))
    docs = [(i, draw(rng.randint(1, 80))) for i in range(700)]
    docs += [(5, docs[5][1]), (None, "w3 w1 w1"), (None, "w3, W1-w1"), (801, None), (802, ""), (803, "..."), (804, "w2 " * 30_000), (805, "common " * 300 + "w0")]
    items = [(i, draw(rng.randint(1, 12))) for i in range(15)] + [(1, "w1 W1 w2"), (None, "w4"), (90, None), (91, ""), (92, "unheard of")]
    left = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("term", F.lit(1)).withColumn("shard", F.lit("x"))
    right = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x")).withColumn("terms", F.lit(1))
    got = lexical.search(lexical.build_index(left, shard_bytes=shard_bytes), right, nearest=nearest).collect()
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == brute_search(docs, items, nearest)


def test_search_query_equals_sql_and_handles_empty_tables(spark):
    assert oracle.compare(QUERIES["op13_lexical_search"](spark, SMALL), oracle.connect(SMALL), ORACLES["op13_lexical_search"]) == []
    docs, items = (spark.read.parquet(f"{SMALL}/{name}.parquet") for name in ("documents", "benchmark"))
    assert lexical.search(lexical.build_index(docs.limit(0)), items).count() == 0
    assert lexical.search(lexical.build_index(docs), items.limit(0)).count() == 0


def test_most_blocks_are_rejected_unopened():
    # A frequent term in many documents, a rare one in few: the frequent list is opened where the rare term is.
    n_docs = 20_000
    rare = np.arange(0, n_docs, 400)
    term = np.r_[np.zeros(n_docs, np.int64), np.ones(len(rare), np.int64)]
    doc = np.r_[np.arange(n_docs), rare]
    lengths = np.full(n_docs, 100)
    _, _, columns = lexical.packed_lists(term, doc, np.ones(len(doc), np.int64), lengths[doc])
    corpus = lexical.Corpus(n_docs, n_docs * 100)
    lists = [lexical.Postings(*[c[i].as_py() for c in columns], lengths, corpus) for i in range(2)]
    weights = [10, 9000]
    scores, found = lexical.max_score(list(zip(weights, lists)), n_docs, np.arange(n_docs), 5)
    assert found.tolist() == rare[:5].tolist() and len(set(scores)) == 1
    assert len(lists[0].open) < len(lists[0].last) / 2
