"""Spelling variants, chunk reuse and conversation repair against brute force, and their odd inputs."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rostersync.llm import chunk_reuse, conversations, queries, spelling
from rostersync.llm.queries import REGISTRY, tokenizer_path

SF_DIR = "/root/testdata/sf0.001"
WORD_BPE = "word_bpe_49k.json"


# --- spelling variants -------------------------------------------------------------------------

def _near(words):
    """All pairs one edit apart, by what is left when one letter is taken away."""
    holes, near = defaultdict(list), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].append(w)
    for (a, b), same in holes.items():
        for w in same:
            near[w] |= {x for x in same if x != w}
            if a + b in words:
                near[w].add(a + b)
                near[a + b].add(w)
    return near


def _variants(counts):
    near, form, out = _near(counts), {}, {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def _got(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in rows}


def test_spelling_query_equals_brute_force(spark):
    lower, counts = str.maketrans(spelling.UPPER, spelling.LOWER), Counter()
    for doc_id, text in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    want = _variants({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    assert _got(REGISTRY["op11_spelling_variants"][0](spark, SF_DIR)) == want and len(want) > 1000


@pytest.mark.parametrize("frequent, most", [(0, 1), (3, 2), (2, 10**9), (10**9, 4)])
def test_spelling_whatever_the_lists(spark, frequent, most):
    """Few letters, so that words are dense; every gram frequent or none, every list divided or none."""
    rng = random.Random(frequent + most)
    words = {"".join(rng.choice("abcé") for _ in range(rng.choice([4, 5, 5, 6, 7, 9]))) for _ in range(500)}
    words |= {"z" * n for n in range(4, 40)} | {"x" * 300, "x" * 301, "y" + "x" * 300}
    counts = {w: rng.choice([1, 2, 3, 5, 9, 20, 50]) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n int").repartition(5)
    assert _got(spelling.variants(df, frequent, most)) == _variants(counts)


def test_gram_bounds_hold_for_every_edit():
    rng = random.Random(3)
    for _ in range(12):
        letters = "abcdefgh"[: rng.randint(2, 8)]
        held = Counter()
        for _ in range(40):
            marked = spelling._marked("".join(rng.choice(letters) for _ in range(rng.randint(5, 9))))
            held.update(marked[p : p + q] for q in (2, 3) for p in range(len(marked) - q + 1))
        frequent = {g: n for g, n in held.items() if n > rng.choice([0, 1, 4])}
        for _ in range(12):
            w = "".join(rng.choice(letters) for _ in range(rng.randint(4, 14)))
            marked = spelling._marked(w)
            grams = spelling.decompose(marked, frequent)
            bound = spelling.affected(marked, grams, frequent)
            assert bound < len(grams)
            for i in range(len(w) + 1):
                for kind, other in [("put", w[:i] + c + w[i:]) for c in letters + "z"] + [("cut", w[:i] + c + w[i + 1 :]) for c in ["", *letters] if i < len(w)]:
                    there = spelling._marked(other)
                    found, shift, at = set(spelling.decompose(there, frequent)), len(there) - len(marked), i + spelling.MARKS
                    kept = sum(
                        e <= at and (s, e) in found or s >= at + (kind == "cut") and (s + shift, e + shift) in found for s, e in grams
                    )
                    assert kept >= len(grams) - bound


def test_very_long_words(spark):
    """Time grows with the letters, not with their square."""
    rng = random.Random(1)
    long = "".join(rng.choice("abc") for _ in range(60_000))
    words = [long, long[:30_000] + "d" + long[30_000:], long[:100] + long[101:], "a" * 50_000]
    began = time.process_time()
    marked = spelling._marked(long)
    spelling.affected(marked, spelling.decompose(marked, {"ab": 9, "abc": 9}), {"ab": 9, "abc": 9})
    assert time.process_time() - began < 5
    counts = dict(zip(words, (9, 4, 3, 5), strict=True))
    got = _got(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n int")))
    assert [got[w][0] for w in words] == [None, long, long, None]


def test_spelling_odd_tables(spark):
    odd = [(1, None), (None, "Hello hello HELLO hellp hellp, hello"), (2, ""), (2, "hello " * 30), (2, "hello " * 30), (3, "École ×÷ école 123 helló")]
    docs = spark.createDataFrame(odd, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    runs = Counter(r["word"] for r in spelling.occurrences(docs).collect())
    assert runs["hello"] == 64 and runs["École"] == 1 and runs["école"] == 1 and runs["×÷"] == 1
    assert spelling.counts(queries.misspelt(spelling.occurrences(docs)), 5, 2).count() >= 2
    some = spark.createDataFrame([("hello", 4, 1), ("hallo", 2, 1), (None, 3, 1), ("hullo", None, 1), ("jello", 4, 1)], "word string, n int, form int")
    # Of two near words with the same number the smaller one is the form.
    assert _got(spelling.variants(some)) == {"hello": (None, "hello", 4, 2, None), "hallo": ("hello", "hello", 2, 1, 4), "jello": (None, "jello", 4, 1, None)}
    assert spelling.variants(some.limit(0)).count() == 0


# --- chunk reuse -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path(WORD_BPE))


def _odd_texts():
    rng = random.Random(8)
    alphabet = "aéÉ 日\n\t́ 'sI<|\U0001f64212\x85​ .,"
    passage = "Some passage, that many documents share; it goes on: and on. " * 12
    texts = [None, "", " ", "\n\n", "x", "日本語" * 2500, "x" * 9000, "a b " * 1500, "İΣς ΑΣ  　" * 150]
    texts += ["<|endoftext|>" * 300, "<|end oftext|> <|ENDOFTEXT|> x\x00y \x1c\x1d" * 60, "é ́a Å " * 200, "It's, we'LL don't. 'sun " * 90]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4000))) for _ in range(60)]
    texts += ["".join(rng.choice("abcd efg") for _ in range(rng.randint(0, 700))) + passage + str(i) for i in range(30)]
    return texts + [passage] * 5


@pytest.mark.parametrize("most", [16_384, 3, 0])
def test_encoding_equals_the_library(spark, tokenizer, most):
    """Whatever the size of the dictionary; repeated rows, nulls and clashing names included."""
    texts = _odd_texts()
    docs = spark.createDataFrame([(i % 90, t, i) for i, t in enumerate(texts)], "doc_id long, text string, ids int").repartition(4)
    got = chunk_reuse.encode(docs, tokenizer_path(WORD_BPE), keep=("ids", "doc_id"), most=most, decoded=True).collect()
    assert len(got) == len(texts)
    for r in got:
        want = tokenizer.encode(texts[r["ids"]] or "", add_special_tokens=False).ids
        assert r["token_ids"] == want and r["decoded"] == tokenizer.decode(want, skip_special_tokens=False)


def test_chunks_do_not_depend_on_what_precedes(spark):
    rng = random.Random(2)
    passage = bytes(rng.choice(b"abcdefgh ") for _ in range(6000))
    cut = [chunk_reuse.chunks(bytes(rng.choice(b"abc ") for _ in range(n)) + passage) for n in (0, 1, 777, 5000)]
    shared = set.intersection(*map(set, cut))
    assert sum(map(len, shared)) > 4000
    for text in (b"", b"a", "日".encode() * 5000, passage * 800, b"x" * (5 << 20)):
        parts = chunk_reuse.chunks(text)
        assert b"".join(parts) == text and all(len(p) <= chunk_reuse.MOST for p in parts)
        assert all(p.decode() or True for p in parts) and all(len(p) >= chunk_reuse.LEAST - 3 for p in parts[:-1])


def test_rolling_hash_in_blocks_equals_one_by_one():
    data = np.random.default_rng(1).integers(0, 256, 500, np.uint8)
    got = chunk_reuse.rolling(data)
    for i in range(chunk_reuse.WINDOW, 500, 37):
        want = sum(int(chunk_reuse.GEAR[data[i - age]]) << age for age in range(chunk_reuse.WINDOW)) % (1 << 32)
        assert int(got[i]) == want


def test_shared_chunks_are_those_of_two_documents(spark):
    texts = [t for t in _odd_texts() if t]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    seen = Counter(c for t in texts for c in set(chunk_reuse.chunks(t.encode())))
    want = {chunk_reuse._hash(c): n for c, n in seen.items() if n > 1}
    got = chunk_reuse.shared_chunks(df).collect()
    assert {r["key"]: r["n"] for r in got} == want
    assert 0 < chunk_reuse.shared_chunks(df, 3).count() <= 3
    known = chunk_reuse.dictionary(df, open(tokenizer_path(WORD_BPE), encoding="utf-8").read())
    assert {chunk_reuse._hash(c) for c in known} == set(want)


def test_windows_grow_until_the_guards_agree(tokenizer):
    """With wrong ids for the neighbours no window agrees, so the whole text is encoded."""
    model = open(tokenizer_path(WORD_BPE), encoding="utf-8").read()
    reuse = chunk_reuse.Reuse(model, {}).open()
    words = [b"one", b"two", b"three", b"joined", b"four", b"five"]
    right = [reuse.words[w] for w in words]
    ids = [*right[:3], None, *right[4:]]
    reuse.repair(words, ids, 3)
    assert b"".join(ids) == b"".join(right)
    ids = [right[1], right[0], right[0], None, right[5], right[4]]
    reuse.repair(words, ids, 3)
    assert b"".join(ids) == b"".join(right)


class _Counting:
    """Passes calls on and notes what they were for."""

    def __init__(self, to):
        self.to, self.seen, self.calls = to, [], 0

    def __getattr__(self, name):
        def call(what, **options):
            self.calls += 1
            self.seen += what if isinstance(what, list) else [what]
            return getattr(self.to, name)(what, **options)

        return call


def test_words_of_plain_signs_are_put_together_from_their_runs(tokenizer):
    """Each run goes to the model once, whatever its spelling and what stands beside it, and no such word to the library."""
    reuse = chunk_reuse.Reuse(open(tokenizer_path(WORD_BPE), encoding="utf-8").read(), {}).open()
    words = reuse.words
    words.tokenizer, words.model = _Counting(words.tokenizer), _Counting(words.model)
    plain = ["straße", "Straße,", "STRAßE&&&", "(365)", "365", "École***", "école", "a-b", "x.y@z.org", "<|straße|>", "!!!", "555-7216"]
    rest = ["it's", "a×b", "a÷", "日本", "x<|endoftext|>y", "<|endoftext|>", "e\u0301", "a\x1cb", "\x7f"]
    for word in [*plain, *rest, *plain]:
        want = tokenizer.encode(word, add_special_tokens=False).ids
        assert np.frombuffer(words[word.encode()], "<i4").tolist() == want, word
    assert words.tokenizer.seen == rest
    assert max(Counter(words.model.seen).values()) == 1


def test_a_slice_of_texts_is_encoded_at_once(tokenizer):
    """Joined words go to the library in one call, and each text comes out as alone."""
    reuse = chunk_reuse.Reuse(open(tokenizer_path(WORD_BPE), encoding="utf-8").read(), {}).open()
    texts = [(t or "").encode() for t in _odd_texts()]
    got = reuse.encode(texts).to_pylist()
    assert got == [tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in texts]
    assert got == [reuse.encode([t]).to_pylist()[0] for t in texts]
    assert reuse.encode([]).to_pylist() == [] and reuse.encode([b"", b" "]).to_pylist() == [[], []]
    rng = random.Random(5)
    plain = [" ".join("".join(rng.choices("aeinst", k=rng.randint(2, 9))) for _ in range(900)).encode() for _ in range(20)]
    reuse.tokenizer = _Counting(reuse.tokenizer)
    assert reuse.encode(plain).to_pylist() == [tokenizer.encode(t.decode(), add_special_tokens=False).ids for t in plain]
    assert reuse.tokenizer.calls == 1 and len(reuse.tokenizer.seen) > 20


def test_tokenizers_that_look_beyond_white_space_are_refused():
    with pytest.raises(ValueError):
        chunk_reuse.check_model(open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8").read())
    model = open(tokenizer_path(WORD_BPE), encoding="utf-8").read()
    chunk_reuse.check_model(model)
    for old, new in (('"NFC"', '"NFKC"'), ('"invert":true', '"invert":false'), ('"dropout":null', '"dropout":0.1'), ('"lstrip":false', '"lstrip":true')):
        compact = model.replace('": ', '":')
        assert old in compact
        with pytest.raises(ValueError):
            chunk_reuse.check_model(compact.replace(old, new))


def test_decode_passes_over_what_is_no_id(spark, tokenizer):
    lists = [(1, None), (2, []), (3, [320, None, 49407, 10**6, -1, 533]), (None, [1])]
    tokens = spark.createDataFrame(lists, "doc_id long, token_ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in chunk_reuse.decode(tokens, tokenizer_path(WORD_BPE)).collect()}
    assert got[1] is None and got[2] == "" and got[None] == tokenizer.decode([1], skip_special_tokens=False)
    assert got[3] == tokenizer.decode([320, 49407, 533], skip_special_tokens=False)
    byte = chunk_reuse.decode(tokens, tokenizer_path("byte_bpe_50k.json")).where("doc_id = 3").first()["decoded"]
    assert byte == Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json")).decode([320, 49407, 533], skip_special_tokens=False)


def test_chunk_reuse_query_and_odd_tables(spark, tokenizer):
    got = Counter(map(tuple, REGISTRY["op12_chunk_reuse"][0](spark, SF_DIR).collect()))
    want = Counter()
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        texts = " ".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False)
        want[r["doc_id"], len(ids), *[hashlib.sha256(t.encode()).hexdigest() for t in texts]] += 1
    assert got == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert chunk_reuse.encode(empty, tokenizer_path(WORD_BPE)).count() == 0
    with pytest.raises(ValueError, match="token_ids"):
        chunk_reuse.encode(empty.withColumn("token_ids", F.lit(1)), tokenizer_path(WORD_BPE), keep=("token_ids",))


# --- conversation repair -----------------------------------------------------------------------

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
SPACE = " \t\n\x0b\x0c\r"


def _cheapest(rows):
    """Every way of editing, kept apart by the last role only: (cost, audit, turns)."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = (text or "").strip(SPACE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    def keep(best, state, way):
        if state is not None and (state not in best or way[:2] < best[state][:2]):
            best[state] = way

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for name in ("user", "assistant"):
                    keep(best, STEP.get((state, name[0])), (cost + 3, audit + "I", (*out, (name, ""))))
        return best

    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, audit, out) in inserted(best).items():
            keep(after, state, (cost + 4, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role:
                    keep(after, STEP.get((state, role[0])), (cost + more, audit + "K", (*out, (role, text))))
                for name in ("user", "assistant"):
                    keep(after, STEP.get((state, name[0])), (cost + more + 3, audit + "R", (*out, (name, text))))
        best = after
    best = inserted(best)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [(role or "")[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    counts = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal)
    return (*counts, *min(best[s] for s in ("", "a") if s in best))


def _in_order(rows):
    return sorted(rows, key=lambda r: [(v is not None, v if v is not None else 0) for v in r])


def _repaired(df, **options):
    return {
        r["conv_id"]: (*tuple(r)[1:8], tuple((t["role"], t["text"]) for t in r["repaired"]))
        for r in conversations.repair(df, **options).collect()
    }


@pytest.fixture(scope="module")
def odd_turns():
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = [None, "", " \n", "Yes.", "Yes", "No!", "Why?", "so.. ", "x ", "long. " * 2000]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, *range(25)]), rng.choice(roles), rng.choice(texts)) for _ in range(400)]
    return rows + rows[:60] + [(6 + i, None, "user", "Alone.") for i in range(3)] + [(9, 2**40, "assistant", None)]


@pytest.mark.parametrize("segment_rows", [50_000, 30, 1])
def test_repair_equals_brute_force(spark, odd_turns, segment_rows):
    df = spark.createDataFrame(odd_turns, "conv_id int, turn long, role string, text string").repartition(6)
    df = df.withColumn("fault", F.lit("clash")).withColumn("seg", F.lit(3)).withColumn("cost", F.lit(1))
    want = {c: _cheapest(_in_order([r[1:] for r in odd_turns if r[0] == c])) for c in {r[0] for r in odd_turns}}
    assert _repaired(df, segment_rows=segment_rows) == want


def test_integer_minimum_is_the_cheapest_and_first_audit():
    """All audits of short conversations, enumerated; the chain of segments gives the same for every cut."""
    rng = random.Random(9)
    kinds = {"s": conversations.SYSTEM, "u": conversations.USER, "a": conversations.ASSISTANT, "t": conversations.OTHER}
    for _ in range(150):
        turns = [(kinds[rng.choice("suat")], rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 70))]
        cost, letters = conversations.solve(turns)
        names = {v: k for k, v in kinds.items()}
        rows = [(i, names[k], ["ok.", "no", "ok.", ""][f]) for i, (k, f) in enumerate(turns)]
        if any(f == conversations.DUPLICATE for _, f in turns):
            rows = None
        if rows is not None:
            # Texts of their own, so that none is a duplicate.
            rows = [(i, r, t and f"{i}{t}") for i, r, t in rows]
            assert (cost, "".join(letters)) == _cheapest(rows)[5:7]
        cuts = sorted(rng.sample(range(1, len(turns)), min(3, len(turns) - 1))) if len(turns) > 1 else []
        parts = [turns[a:b] for a, b in zip([0, *cuts], [*cuts, len(turns)], strict=True)]
        if turns:
            sums = [conversations.paths(p, entry)[:2] for p in parts for entry in range(4)]
            segments = [
                {"costs": [-1 if c is None else c for k in range(4) for c in sums[4 * i + k][0]], "ranks": [r for k in range(4) for r in sums[4 * i + k][1]]}
                for i in range(len(parts))
            ]
            solved = [conversations.solve(p, a, b) for p, (a, b) in zip(parts, conversations.chain(segments), strict=True)]
            assert sum(c for c, _ in solved) == cost and "".join(x for _, ls in solved for x in ls) == "".join(letters)


def test_repair_query_equals_brute_force(spark):
    by, every = defaultdict(list), set()
    for conv, turn, role, text in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        every.add(conv)
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text or " ")}.get(what, text if text is not None else " ")
        by[conv] += [(turn, "user" if what == 4 else role if role is not None else " ", text)] * [0, 1, 1, 2, 1][min(what, 4)]
    got = {r[0]: tuple(r)[1:] for r in REGISTRY["op13_conversation_repair"][0](spark, SF_DIR).collect()}
    assert set(got) == every
    for conv in every:
        *numbers, out = _cheapest(_in_order(by[conv]))
        assert got[conv] == (*numbers, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def test_damage_and_empty_tables(spark, tmp_path):
    rows = [(None, None, None, None)] + [(c, t, "assistant", "Fine! So.") for c in range(12) for t in (None, *range(12))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = Counter(map(tuple, queries.damaged(df).collect()))
    want = Counter()
    for conv, turn, role, text in rows:
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role or " ", text or " "
        out = {1: (conv, turn, role, ""), 2: (conv, turn, role, re.sub("[.!?]", "", text)), 4: (conv, turn, "user", text)}.get(what, (conv, turn, role, text))
        want[conv, turn, out[2], out[3]] += 0 if what == 0 else 2 if what == 3 else 1
    assert got == +want
    empty = spark.createDataFrame([], df.schema)
    assert conversations.repair(empty).count() == 0
    # A conversation that loses all its rows is reported all the same.
    gone = next((c, t) for c in range(1000) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(*gone, "user", "Hi.")], df.schema).write.parquet(f"{tmp_path}/gone/conversations.parquet")
    only = REGISTRY["op13_conversation_repair"][0](spark, f"{tmp_path}/gone").collect()
    assert [tuple(r) for r in only] == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
