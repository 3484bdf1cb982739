"""The numbered operators against brute force, on small odd tables and on the small test tables."""

import itertools
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from oracle_check import compare, connect
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rostersync.llm import language, lattice
from rostersync.llm import resample as resample_module
from rostersync.llm.common import n_words
from rostersync.llm.components import components
from rostersync.llm.host_rules import judge, repeated_words
from rostersync.llm.interleave import _numbered_by_range, interleave
from rostersync.llm.lattice import ROOTS, near_vectors, nearest_e8
from rostersync.llm.line_spread import drop_shared_lines, without_shared_lines
from rostersync.llm.mixing import mix, mixture
from rostersync.llm.ngram_join import OVERLAP_FRAGMENTS, _fragments, _overlaps, one_of_each, similar_documents
from rostersync.llm.pieces import UNIGRAM, PieceModel, decode, encode
from rostersync.llm.queries import REGISTRY, tokenizer_path
from rostersync.llm.resample import kth_largest, resample
from rostersync.llm.token_counts import frequent_words, token_counts

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, size int, row string, key long"
LONG = " ".join(f"w{i % 97} x{i % 89}" for i in range(4000))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    texts = [
        None, "", "   \n\t", "one two", "A b C d e f g", "a B c D E F G", LONG, LONG + " end", "Ärger über Öl!\nno | yes # $",
        "same line here\nown line one", "same line here\nown line two", "same line here\nown line three", "123 456",
        "<|endoftext|> x", "日本語 🙂 ▁ x\x00y",
    ]
    rows = [(i, t, "en", f"s{i % 4}", 1, 7, "r", 3) for i, t in enumerate(texts)]
    rows += [(3, "one two", "en", "s3", 1, 7, "r", 3)] * 2 + [(None, "null id text of six words", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", [n for n, (_, sql) in REGISTRY.items() if sql])
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    query, sql = REGISTRY[name]
    assert compare(query(spark, SF_DIR), con, sql) == []


def test_empty_tables(spark, odd, none, tmp_path):
    empty_vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    ids = spark.createDataFrame([], "doc_id long")
    made = [
        mix(none, n_words(F.col("text"))), mixture(none, n_words(F.col("text"))), drop_shared_lines(none), without_shared_lines(none),
        near_vectors(empty_vectors), judge(none), interleave(none), language.identify(none, language.fit(none)),
        encode(none, tokenizer_path("piece_bpe_32k.model")), token_counts(none, tokenizer_path("byte_bpe_50k.json")),
        resample(none, ids, 0.5), similar_documents(none), one_of_each(none),
    ]
    assert [df.count() for df in made] == [0] * len(made)


def test_mix_comes_near_its_targets(spark, odd):
    docs = spark.createDataFrame([(i, f"s{i % 7}", 1 + i * 37 % 50) for i in range(7000)], "doc_id long, source string, size int")
    rows = mix(docs, F.col("size"), shares=(0.3, 1.5)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"] % 7, r["target"]].append(r)
        assert r["nested"][0] <= r["nested"][1] == r["copies"] <= 2
    for (_, target), group in by.items():
        assert abs(sum(r["size"] * r["copies"] for r in group) - target) <= 25
    assert math.isclose(sum(t for _, t in by), 1.5 * sum(r["size"] for r in rows))
    assert mix(odd, n_words(F.col("text"))).count() == odd.count()
    mixed = mixture(odd, n_words(F.col("text")))
    assert mixed.columns == odd.columns
    wanted = mix(odd, n_words(F.col("text"))).agg(F.sum("copies")).first()[0]
    assert mixed.count() == wanted


def test_shared_lines_stay_once(odd):
    rows = {r["row"]["doc_id"]: r for r in drop_shared_lines(odd, min_sites=3).collect()}
    assert rows[9]["clean"] == "same line here\nown line one" and rows[9]["n_removed"] == 0
    assert rows[10]["clean"] == "own line two" and rows[11]["clean"] == "own line three"
    assert rows[0]["clean"] is None and rows[0]["n_lines"] == 0 and rows[1]["clean"] == "" and rows[1]["n_lines"] == 1
    kept = without_shared_lines(odd, min_sites=3)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_hosts_by_many_short_documents(spark, odd):
    good = " ".join(f"word{i}" for i in range(60))
    docs = [(i, good if i % 10 else "short", "fine") for i in range(200)]
    docs += [(1000 + i, "short" if i % 10 else good, "bad") for i in range(200)] + [(5000, good, None), (5001, "short", "tiny"), (5002, good, "tiny")]
    kept = {r["doc_id"]: r["kept"] for r in judge(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert kept[1] and not kept[0] and not kept[1000] and kept[5000]
    assert {r["kept"] for r in judge(odd).collect()} <= {True, False} and judge(odd).count() == odd.count()


def test_repeated_words():
    texts = ["a a a a", "a b c a b c", "a b", "x y z q x y", ""]
    numbers = {}
    flat = [numbers.setdefault(w, len(numbers)) for t in texts for w in t.split()]
    counts = np.array([len(t.split()) for t in texts])
    assert repeated_words(np.array(flat), counts).tolist() == [4, 6, 0, 0, 0]


def test_interleaved_shards(spark, odd):
    docs = spark.createDataFrame([(i, f"text {i}", "hot" if i % 3 else f"s{i % 5}") for i in range(9001)], "doc_id long, text string, source string")
    rows = interleave(docs).collect()
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1 and sorted(counts) == list(range(8))
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    for source, n in Counter(r["source"] for r in rows).items():
        for shard in range(8):
            assert abs(sum(r["source"] == source and r["shard"] == shard for r in rows) - n / 8) <= 1
    assert all(r["text_crc32"] == zlib.crc32(f"text {r['doc_id']}".encode()) for r in rows)
    assert {r["doc_id"]: r["size"] for r in interleave(odd).collect()}[0] == 1


def test_network_gradients():
    w = language.Weights.fresh(3, 4, 1)
    make = np.random.default_rng(0)
    segments, labels, mask = make.integers(0, 256, (5, 6)).astype(np.uint8), np.array([0, 1, 2, 0, 1]), np.ones((5, 6), bool)
    mask[2, 4:] = False
    _, grads = language.gradients(w, segments, labels, mask)
    for a, g in zip(w.parts(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), a.shape)
        old, losses = a[at], []
        for step in (0.01, -0.01):
            a[at] = old + step
            losses.append(language.gradients(w, segments, labels, mask)[0])
        a[at] = old
        assert math.isclose((losses[0] - losses[1]) / 0.02, g[at], rel_tol=0.1)


def test_languages_are_told_apart(spark, odd):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.fit(docs)
    named = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right = named.filter(language.held_out(F.col("doc_id"))).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9
    found = {r["doc_id"]: r for r in language.identify(odd, model).collect()}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (0, 1, 2, 12))
    kept = language.in_known_language(odd)
    assert kept.columns == odd.columns and not {0, 1, 2, 12} & {r["doc_id"] for r in kept.collect()}


def test_pieces_are_those_of_the_library(spark, odd):
    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = encode(docs, path, keep=("doc_id", "text")).collect()
    for r in rows:
        assert r["piece_ids"] == (None if r["text"] is None else library.encode(r["text"]))
        assert r["round_trip"] == (None if r["text"] is None else "▁" not in r["text"])
    back = decode(encode(docs, path, keep=("doc_id", "text")).withColumnRenamed("text", "old"), path, keep=("old",)).collect()
    assert all(r["text"] == (None if r["old"] is None else r["old"].replace("▁", " ")) for r in back)


def test_unigram_paths_have_the_best_score():
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        model = PieceModel(file.read(), UNIGRAM)
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    ids = {library.id_to_piece(i): i for i in range(259, 32000)}
    for word in ("▁hello", "▁and", "xyzzy", "▁▁abab"):
        best = -math.inf
        for cuts in itertools.product((0, 1), repeat=len(word) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
            parts = [word[a:b] for a, b in zip(at, at[1:], strict=False)]
            if all(p in ids for p in parts):
                best = max(best, sum(library.get_score(ids[p]) for p in parts))
        found = np.frombuffer(model.encode_words([word])[0], np.int32)
        assert sum(library.get_score(int(i)) for i in found) == best


def test_tokens_are_those_of_the_library(spark, odd):

    path = tokenizer_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert Counter(map(tuple, token_counts(docs, path, frequent=500).collect())) == want


def test_resampling(spark, odd):
    docs = [(i, "good fine text words " * 8 if i % 2 else "### $$$ junk junk " * 8) for i in range(400)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    kept = resample(docs, docs.filter("doc_id % 10 = 1").select("doc_id"), 0.5).collect()
    assert sum(r["kept"] for r in kept) == 200 and all(r["kept"] == (r["doc_id"] % 2 == 1) for r in kept)
    rows = resample(odd, odd.select("doc_id"), 1.0).collect()
    assert {r["doc_id"] for r in rows if not r["kept"]} == {0, 1, 2} and len(rows) == odd.count()
    values = spark.range(50_000).select((F.col("id") * 7919 % 50_021).cast("double").alias("v"))
    order = sorted((i * 7919 % 50_021 for i in range(50_000)), reverse=True)
    assert [kth_largest(values, "v", k) for k in (1, 777, 40_000)] == [order[0], order[776], order[39_999]]


def test_e8():
    assert len(ROOTS) == 240 and np.allclose((ROOTS**2).sum(axis=1), 2)
    x = np.random.default_rng(1).standard_normal((500, 8))
    near = nearest_e8(x)
    assert np.allclose(nearest_e8(near), near)
    assert all((((x - near) ** 2).sum(axis=1) <= ((x - near - r) ** 2).sum(axis=1) + 1e-9).all() for r in ROOTS)


def brute_components(n, links):
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root
    return root


def test_vectors_against_all_pairs(spark):
    make = np.random.default_rng(2)
    base = make.standard_normal((40, 32))
    x = np.concatenate([base, base + 0.1 * make.standard_normal(base.shape), base[:5], 3 * base[5:9]]).astype(np.float32)
    label = [i % 2 for i in range(len(x))]
    rows = [(i, v.tolist(), k) for i, (v, k) in enumerate(zip(x, label, strict=True))]
    odd = [(900, None, 1), (901, [0.0] * 32, 1), (902, [float("nan")] * 32, 1), (903, x[0].tolist(), None), (904, [None] + [1.0] * 31, 1), (905, [], 1)]
    found = {r["vec_id"]: r for r in near_vectors(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = [(a, b) for a in range(len(x)) for b in range(a) if label[a] == label[b] and unit[a] @ unit[b] >= 0.98]
    degree, root = Counter(v for p in links for v in p), brute_components(len(x), links)
    for i in range(len(x)):
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (degree[i], root[i], root[i] == i)
    assert all(found[i]["n_links"] == 0 and found[i]["component_id"] == i and found[i]["kept"] for i in range(900, 906))


def test_components(spark):
    make = np.random.default_rng(3)
    links = [tuple(map(int, p)) for p in make.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 480)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = brute_components(500, links)
    assert found == {v: root[v] for p in links for v in p if p[0] != p[1]}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_similar_documents_against_all_pairs(spark, odd):
    make = np.random.default_rng(4)
    base = [[f"w{x}" for x in make.integers(0, 5000, 120)] for _ in range(12)]
    texts = []
    for b in base:
        for edits in range(14):
            words = list(b)
            for at in make.choice(120, edits // 2, replace=False):
                words[at] = f"e{make.integers(0, 30)}"
            texts.append(" ".join(words))
    hot = " ".join(f"h{i}" for i in range(60))
    texts += [hot + " " + " ".join(f"u{k}x{i}" for i in range(8 + k % 12)) for k in range(40)] + texts[:20]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, texts[i]) for i in (0, 0, 0, 30)]
    found = {r["doc_id"]: r for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    sets = [shingles(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = brute_components(len(sets), links)
    assert [found[i]["component_id"] for i in range(len(sets))] == root
    assert [found[i]["n_shingles"] for i in range(len(sets))] == [len(s) for s in sets]
    result = {r["doc_id"]: r for r in similar_documents(odd).collect()}
    assert [result[i]["component_id"] for i in range(8)] == [0, 1, 2, 3, 4, 4, 6, 6] and result[None]["component_id"] is None
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([None, 0, 1, 2, 3, 4, 6, *range(8, 15)])


def test_least_score_follows_the_number_of_languages(spark):
    assert [round(language.least_score(n, language.LEAD), 3) for n in (2, 3, 4, 100)] == [0.533, 0.378, 0.3, 0.076]
    assert language.least_score(1, language.LEAD) < 1
    docs = spark.createDataFrame([(1, "words", None), (2, "mehr Wörter", None), (3, "12 3", None), (4, None, None)], "doc_id long, text string, lang string")
    assert language.fit(docs) is None
    assert sorted(r["doc_id"] for r in language.in_known_language(docs).collect()) == [1, 2]


def test_a_full_sample_holds_every_language(spark, monkeypatch):
    names = [f"l{i:02}" for i in range(12)]
    docs = spark.createDataFrame([(i, f"text number {i}", names[i * i % 12 if i % 3 else i % 12]) for i in range(600)], "doc_id long, text string, lang string")
    present = {r["lang"] for r in docs.filter(~language.held_out(F.col("doc_id"))).select("lang").distinct().collect()}
    monkeypatch.setattr(language, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    monkeypatch.setattr(language, "train", lambda texts, labels, n: Counter(labels.tolist()))
    runs = [language.fit(docs.repartition(n)) for n in (2, 7)]
    counts, languages = runs[0]
    assert runs[0] == runs[1] and set(languages) == present and sum(counts.values()) == 20
    assert max(counts.values()) - min(counts.values()) <= 1


def test_long_words_are_those_of_the_library(spark):
    """Texts without spaces: 20,000 characters take a fraction of a second, a megabyte some seconds."""
    path, rng = tokenizer_path("piece_bpe_32k.model"), np.random.default_rng(4)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    with open(path, "rb") as file:
        data = file.read()
    model = PieceModel(data)
    letters = "abcdefghijklmnopqrstuvwxyz"
    alphabets = {"cjk": [chr(c) for c in range(0x4E00, 0x9FA6)], "ascii": list(letters), "base64": [*letters, *letters.upper(), *"0123456789+/"],
                 "odd": list("aé日\t\u0301's<|\U0001f64212\x85\u200b=-_.,"), "syllables": ["the", "in", "ation", "日", "==", "x"], "one": ["a"]}
    model.encode(["warm up"])
    for name, alphabet in alphabets.items():
        text = "".join(alphabet[i] for i in rng.integers(0, len(alphabet), 20_000))
        began = time.process_time()
        ids, counts = model.encode([text])
        assert time.process_time() - began < 2, name
        assert ids.tolist() == library.encode(text) and counts.tolist() == [len(ids)], name
    text = "".join(letters[i] for i in rng.integers(0, 26, 1_000_000))
    assert model.encode([text])[0].tolist() == library.encode(text)
    for size in (31, 33, 64, 65, 200, 300):
        texts = ["".join(alphabets["syllables"][i] for i in rng.integers(0, 6, size)) for _ in range(40)]
        ids, counts = model.encode(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == library.encode(texts)
    unigram = PieceModel(data, UNIGRAM)
    for _ in range(60):
        word = "▁" + "".join(alphabets["syllables"][i] for i in rng.integers(0, 6, 40))
        assert unigram._encode_long(word) == unigram._encode_equal([word])[0]


def test_decode_passes_over_what_is_no_id(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    good = library.encode("Some words here")
    rows = [(1, None), (2, []), (3, [good[0], None, 10**7, -1, *good[1:]]), (4, good), (4, good)]
    df = spark.createDataFrame(rows, "doc_id long, piece_ids array<int>")
    got = sorted(map(tuple, decode(df, path).collect()))
    assert got == [(1, None), (2, ""), (3, "Some words here"), (4, "Some words here"), (4, "Some words here")]
    assert decode(df.limit(0), path).count() == 0


def test_kept_columns_called_like_results_are_refused(spark, odd):
    for name in ("piece_ids", "N_pieces"):
        with pytest.raises(ValueError, match=name):
            encode(odd.withColumn(name, F.lit(1)), tokenizer_path("piece_bpe_32k.model"), keep=(name,))
    with pytest.raises(ValueError, match="score"):
        language.identify(odd.withColumn("score", F.lit(1)), None, keep=("score",))


def test_sample_of_pre_tokens_takes_the_same_jobs_whatever_the_partitions(spark, odd):
    def jobs(parts):
        group = f"sample-{parts}"
        spark.sparkContext.setJobGroup(group, group)
        frequent_words(odd.repartition(parts), "doc_id", "text", 100, 10, 1000)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(24) <= jobs(2) + 1


def test_token_counts_of_another_tokenizer_are_the_librarys(spark, odd):
    """One that lower-cases, normalizes and splits otherwise."""
    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = Counter((r["doc_id"], r["n_tokens"]) for r in token_counts(odd, path).collect())
    want = Counter((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert got == want


def test_interleave_equals_plain_python(spark):
    """A third of all rows are sources of one row, which all have the fraction one half."""
    rng = np.random.default_rng(6)
    rows = [(i, f"text {rng.integers(0, 50)}", f"one{i}") for i in range(900)]
    rows += [(i, f"text {i % 70}", "big") for i in range(900, 1800)]
    rows += [(i, None if i % 9 == 0 else "x", [None, "two", "Two", "three"][i % 4]) for i in range(1800, 2700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    key = F.shiftrightunsigned(F.xxhash64(F.lit(5), F.col("doc_id"), F.col("text")), 4)
    keys = {r["doc_id"]: r["key"] for r in df.select("doc_id", key.alias("key")).collect()}
    by = defaultdict(list)
    for doc_id, _, source in rows:
        by[source].append(doc_id)
    order = []
    for source, ids in by.items():
        for rank, doc_id in enumerate(sorted(ids, key=lambda i: (keys[i], i))):
            order.append(((rank + 0.5) / len(ids), source is None, source or "", rank, doc_id))
    n, want = len(rows), {}
    for place, (*_, doc_id) in enumerate(sorted(order)):
        shard = place * 8 // n
        want[doc_id] = shard, place - -(-shard * n // 8)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in interleave(df, 8).collect()}
    assert got == want


def test_ranges_of_ties_are_even(spark):
    """Rows that agree in the fraction are cut by the rest of their order."""
    df = spark.range(4000).select(F.lit(0.5).alias("part"), F.col("id").cast("string").alias("source"), F.lit(0).alias("place"))
    order = [F.col("part"), F.col("source").asc_nulls_last(), F.col("place")]
    ranged = df.repartitionByRange(8, *order).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(ranged) > 4 and max(r["count"] for r in ranged) < 1200
    ranks = sorted((r["source"], r["rank"]) for r in _numbered_by_range(df, order, "test").collect())
    assert ranks == [(s, i) for i, s in enumerate(sorted(map(str, range(4000))))]


def test_boilerplate_of_many_sizes_against_all_pairs(spark):
    """Texts that share a long passage and differ in how much they have of their own, some of it shared again."""
    rng = random.Random(12)
    common = [f"c{i}" for i in range(104)]
    texts = []
    for i in range(160):
        own = [f"o{i}_{j}" for j in range(rng.choice([0, 3, 10, 14, 18, 22, 26, 40]))]
        extra = [f"e{rng.randint(0, 12)}_{j}" for j in range(rng.choice([0, 0, 6, 12, 20]))]
        cut = rng.randint(0, 20)
        texts.append(" ".join([*common[cut:], *extra, *own] if rng.random() < 0.7 else [*own, *common[: len(common) - cut], *extra]))
    sets = [{tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in map(str.split, texts)]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(df).collect()}
    assert got == {i: find(i) for i in range(len(sets))}
    assert 20 < len(set(got.values())) < 150


def test_partial_overlaps_are_summed_per_pair(spark):
    rng = random.Random(2)
    sets = {n: sorted(rng.sample(range(-(2**63), 2**63, 2**55), rng.randint(0, 200))) for n in range(12)}
    made = spark.createDataFrame([(n, len(g), g) for n, g in sets.items()], "node long, n long, grams array<long>")
    rows = _fragments(made)
    assert rows.count() == 12 * OVERLAP_FRAGMENTS
    pairs = spark.createDataFrame(list(itertools.combinations(sets, 2)), "a long, b long")
    got = {(r["a"], r["b"]): r["common"] for r in _overlaps(pairs, rows).collect()}
    assert got == {(a, b): len({*sets[a]} & {*sets[b]}) for a, b in itertools.combinations(sets, 2)}


def _log_weights(texts, targets, buckets):
    """Word and pair models kept in dictionaries, one word after the other."""
    mask, mix = 2**64 - 1, int(resample_module.MIX)

    def bucket(key):
        key = key * mix & mask
        key ^= key >> 31
        return ((key * mix & mask) >> 33) % buckets

    def found(text):
        words = [zlib.crc32(w) + 1 for w in (text or "").encode().lower().split()]
        return [bucket(w) for w in words] + [bucket(((a << 32) + b) & mask) for a, b in zip(words, words[1:], strict=False)]

    raw, target = Counter(), Counter()
    for i, text in enumerate(texts):
        raw.update(found(text))
        if i in targets:
            target.update(found(text))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    ratio = lambda g: math.log((target[g] + 1) / n_target) - math.log((raw[g] + 1) / n_raw)
    return [math.fsum(map(ratio, found(t))) if found(t) else None for t in texts]


@pytest.mark.parametrize("buckets", [None, 64])
def test_log_weights_equal_dictionaries(spark, buckets):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["Ä", "b", "C c", "dog\tcat", "é", "x" * 50]) for _ in range(rng.randint(0, 40))) for _ in range(200)] + [None, "", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    targets = spark.createDataFrame([(i,) for i in (*range(0, 200, 3), 5000, None)], "doc_id long")
    got = {r["doc_id"]: r["log_weight"] for r in resample(df, targets, 0.3, buckets=buckets).collect()}
    want = _log_weights(texts, set(range(0, 200, 3)), buckets or resample_module.LEAST_BUCKETS)
    for i, weight in enumerate(want):
        assert got[i] == (None if weight is None else pytest.approx(weight, rel=1e-9, abs=1e-9))


def test_buckets_grow_with_the_documents():
    assert [resample_module.buckets_for(n) for n in (0, 1, 10**4, 2**16, 2**16 + 600, 10**6, 10**12)] == [2**14, 2**14, 2**14, 2**14, 2**15, 2**16, 2**20]


def _probabilities(w, text):
    """The network one position, unit and byte after the other, in plain Python."""
    steps, hidden, languages = language.STEPS, w.u.shape[2], w.c.shape[0]
    sums = [0.0] * languages
    for start in range(0, len(text), steps):
        piece = text[start : start + steps]
        padded = piece + b" " * (steps - len(piece))
        states = []
        for d in range(2):
            h, seen = [0.0] * hidden, []
            for byte in padded if d == 0 else reversed(padded):
                a = [sum(float(w.u[d, k, j]) * h[j] for j in range(hidden)) for k in range(3 * hidden)]
                z = [1 / (1 + math.exp(-(a[j] + float(w.x[d, j, byte])))) for j in range(hidden)]
                r = [1 / (1 + math.exp(-(a[hidden + j] + float(w.x[d, hidden + j, byte])))) for j in range(hidden)]
                new = [math.tanh(r[j] * (a[2 * hidden + j] + float(w.b[d, j, 0])) + float(w.x[d, 2 * hidden + j, byte])) for j in range(hidden)]
                h = [z[j] * h[j] + (1 - z[j]) * new[j] for j in range(hidden)]
                seen.append(h)
            states.append(seen if d == 0 else seen[::-1])
        for t in range(len(piece)):
            logits = [
                float(w.c[k, 0]) + sum(float(w.v[d, k, j]) * states[d][t][j] for d in range(2) for j in range(hidden)) for k in range(languages)
            ]
            top = max(logits)
            total = sum(math.exp(x - top) for x in logits)
            for k in range(languages):
                sums[k] += math.exp(logits[k] - top) / total
    return [s / max(len(text), 1) for s in sums]


def test_network_equals_plain_loops():
    """Texts of one byte, of less and more than a segment, and an empty one."""
    w = language.Weights.fresh(3, 4, 2)
    rng = np.random.default_rng(3)
    for a in w.parts():
        a += rng.normal(0, 0.5, a.shape).astype(np.float32)
    texts = [b"x", b"", "Größe, où?".encode() * 3, bytes(rng.integers(0, 256, 2 * language.STEPS + 7, np.uint8)), b"a" * language.STEPS]
    got = language.document_probabilities(w, texts)
    for text, row in zip(texts, got, strict=True):
        assert row.tolist() == pytest.approx(_probabilities(w, text), abs=2e-5)


@pytest.mark.parametrize("least, blocks", [(0.98, 2), (0.98, 3), (0.98, 5), (0.95, 2), (0.9, 2)])
def test_share_of_pairs_that_meet(least, blocks):
    """Real vectors of 40 numbers at the threshold, hashed by real projections, meet as often as was worked out."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 40))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rng.standard_normal(x.shape)
    away -= (away * x).sum(axis=1, keepdims=True) * x
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    y = least * x + math.sqrt(1 - least * least) * away
    met = []
    for table in range(4):
        a, b = lattice.cells(x, table, blocks), lattice.cells(y, table, blocks)
        met.append((a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1))
    share = np.mean(met)
    assert lattice.meeting(least, blocks) <= share + 0.02 and share <= lattice.meeting(least, blocks) + 0.05
    # And the planned number of tables finds all but a few in a hundred thousand.
    assert (1 - lattice.meeting(least, blocks)) ** lattice.plan(2 ** (8 * blocks), least)[1] <= lattice.MISS


def test_plans_for_any_size_and_threshold():
    assert [lattice.plan(n, 0.98)[0] for n in (0, 1000, 2**20, 2**33, 10**12)] == [2, 2, 3, 5, 5]
    assert lattice.plan(10**4, 0.95)[1] > lattice.plan(10**4, 0.98)[1]
    with pytest.raises(ValueError, match="too far"):
        lattice.plan(10**9, 0.3)


def test_vectors_at_a_lower_threshold_against_all_pairs(spark):
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((60, 24))
    x = np.repeat(centres, 6, axis=0) + rng.standard_normal((360, 24)) * rng.choice([0.1, 0.25, 0.4], (360, 1))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.93).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(df, 0.93).collect()}
    assert [got[i] for i in range(360)] == want.tolist() and want.sum() > 300


def test_vectors_with_null_and_repeated_ids_and_clashing_columns(spark):
    a, b, c = [1.0, 0.0, 0.1], [1.0, 0.0, 0.12], [0.0, 1.0, 0.0]
    rows = [(None, a, 1), (5, b, 1), (5, b, 1), (7, c, 1), (8, c, 2), (None, c, 2), (None, [0.0, 0.0, 1.0], 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for name in ("node", "n_links", "component_id", "kept", "a", "b", "cell", "first", "copies"):
        df = df.withColumn(name, F.lit("clash"))
    got = Counter(map(tuple, near_vectors(df).collect()))
    assert got == Counter(
        [(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (7, 0, 7, True), (8, 1, 8, True), (None, 1, 8, False), (None, 0, None, True)]
    )


def test_host_rules_on_odd_rows(spark, odd):
    """Counts of every odd text by plain Python."""
    got = {r["doc_id"]: r for r in judge(odd).collect()}
    for r in odd.collect():
        words, text = (r["text"] or "").encode().split(), r["text"] or ""
        lines = [line for line in text.split("\n") if line.encode().split()]
        grams = defaultdict(list)
        for i in range(len(words) - 2):
            grams[tuple(words[i : i + 3])].append(i)
        repeated = {i + k for places in grams.values() if len(places) > 1 for i in places for k in range(3)}
        have = got[r["doc_id"]]
        want = (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated))
        assert tuple(have[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want
        assert have["base_failed"] == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (have["kept"] and have["base_failed"])
