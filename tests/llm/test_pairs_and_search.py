"""SimHash components, MaxScore search, suffix dedup and secret scanning against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash


from trendlens.llm import maxscore, secret_scan, simhash_trie, suffix_dedup

DOC = "doc_id long, text string"


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(keys, 2):
        if linked(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_simhash_components_match_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(9001, None), (9002, ""), (9003, " \t"), (9004, rows[3].text), (9005, "x" * 200_000), (9006, "one two"), (9007, "One  TWO")]
    df = spark.createDataFrame([(i, t, i, "c") for i, t in rows], "doc_id long, text string, fp long, root string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_trie.near_duplicate_components(df).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    own = brute_components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert got == {i: (format(fps[i], "016x"), own[i]) for i in fps}


@pytest.mark.parametrize("seed", range(4))
def test_tries_find_all_links(seed):
    rng = np.random.default_rng(seed)
    values = []
    for x in rng.integers(0, 1 << 63, 40, dtype=np.uint64):
        for _ in range(6):
            y = int(x)
            for b in rng.integers(0, 64, rng.integers(0, 7)):
                y ^= 1 << int(b)
            values.append(y)
    values = np.unique(np.array(values, np.uint64))
    expected = brute_components(range(len(values)), lambda a, b: (int(values[a]) ^ int(values[b])).bit_count() <= 4)
    links = set()
    for start in range(8):
        t = np.uint64(8 * start)
        turned = (values << t) | (values >> (np.uint64(64) - t)) if start else values
        order = np.argsort(turned)
        label = simhash_trie.connected_leaves(turned[order], 4, chunk=64)
        links |= {tuple(sorted((int(order[i]), int(order[label[i]])))) for i in range(len(label))}
    assert brute_components(range(len(values)), lambda a, b: (a, b) in links) == expected


def test_subtrie_split_keeps_links(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = sorted({x ^ sum(1 << b for b in rng.sample(range(64), k)) for x in base for k in (0, 1, 3, 4)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    expected = brute_components(sorted(signed), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)
    for limit in (1, 1000):
        links = {(min(r), max(r)) for r in simhash_trie.fingerprint_links(df, 4, limit).collect()}
        assert brute_components(sorted(signed), lambda a, b, links=links: (a, b) in links) == expected


def test_maxscore_shard_is_exact():
    rng = np.random.default_rng(1)
    for _ in range(150):
        n, dims = int(rng.integers(1, 200)), int(rng.integers(1, 12))
        vectors, query = rng.integers(-4, 5, (n, dims)).astype(float), rng.integers(-4, 5, dims).astype(float)
        ids = np.sort(rng.choice(500, n))
        own = int(rng.choice(ids))
        got = maxscore.shard_top_k(ids, vectors, own, query, 5, block=16, probe=2)
        assert list(zip(-got[1], got[0], strict=True)) == sorted((-(v @ query), i) for i, v in zip(ids, vectors, strict=True) if i != own)[:5]


def test_maxscore_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, nan]), (2, None), (3, [inf, 0.0]), (4, [None, 1.0]), (5, []), (6, [0.5]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (50, [-0.001, 0.0]), (100, [1e30, 1e30]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in maxscore.search_every_nth(df, k=3).collect())
    top = (1 << 63) - 1
    assert [r for r in got if r[0] == 0] == [(0, 1, 100, top), (0, 2, 7, 256 * 256 + 512 * 512), (0, 3, 7, 256 * 256 + 512 * 512)]
    assert [r[1:3] for r in got if r[0] == 50] == [(1, 5), (2, 6), (3, 0)]
    assert maxscore.search_every_nth(df.limit(0)).count() == 0


def brute_repeats(texts, length=400):
    count = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, int)
        for s in range(len(t) - length + 1):
            if count[t[s : s + length]] > 1:
                gone[s] += 1
                gone[s + length] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~mask]) if t else b""
        runs = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        out.append((len(t), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_matches_brute_force(spark):
    rnd = random.Random(11)
    words = lambda n: " ".join(rnd.choice(["alpha", "beta", "délta", "x", "lorem", "zeta"]) + str(rnd.randint(0, 999)) for _ in range(n))
    passages = [words(rnd.randint(40, 200)) for _ in range(10)]
    rows = []
    for i in range(70):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) // 2)
            parts.append(p[a : rnd.randint(a, len(p))] if rnd.random() < 0.6 else words(rnd.randint(1, 120)))
            parts += ["ab" * rnd.randint(100, 500)] * (rnd.random() < 0.1) + ["q" * rnd.randint(300, 900)] * (rnd.random() < 0.05)
        rows.append((i, rnd.choice([" ", "", "\n"]).join(parts)))
    rows += [(500, rows[3][1]), (500, rows[3][1]), (501, None), (None, ""), (None, rows[4][1]), (502, "a" * 399), (503, "b" * 400), (504, "b" * 401), (3, rows[3][1][:700])]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, uid int, at string")
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted((tuple(r) for r in suffix_dedup.deduplicate(df).collect()), key=key)
    assert got == sorted(((i, *b) for (i, _), b in zip(rows, brute_repeats([(t or "").encode() for _, t in rows]), strict=True)), key=key)
    assert suffix_dedup.deduplicate(spark.createDataFrame([], DOC)).count() == 0


def test_suffix_ranks_order_suffixes(spark):
    rng = np.random.default_rng(3)
    base = [rng.integers(1, 5, rng.integers(5, 40)).tolist() for _ in range(4)]
    strings = []
    for i in range(25):
        s = []
        for _ in range(3):
            b = base[rng.integers(0, 4)]
            a = int(rng.integers(0, len(b)))
            s += b[a : a + int(rng.integers(1, 30))] + [0, 0, 0] * int(rng.random() < 0.5)
        strings.append((i, [int(x) for x in s] + [0, 0, 0]))
    strings.append((25, [1, 0, 0, 0, 2, 0, 0, 0, 3, 0, 0, 0, 4, 0, 0, 0]))  # every symbol is there twice
    strings.append((26, [4, 3, 0, 0, 0, 2, 1, 0, 0, 0]))
    df = spark.createDataFrame(strings, "ord long, syms array<long>")
    suffix = lambda s, i: tuple(itertools.takewhile(bool, s[i:]))
    places = {(o, i): suffix(s, i) for o, s in strings for i in range(len(s)) if s[i]}
    rank = {(r.ord, i): x for r in suffix_dedup.ranks(df, 3).collect() for i, x in enumerate(r.ranks)}
    ordered = sorted((places[p][:27], rank[p]) for p in places)
    assert all(a[1] < b[1] for a, b in itertools.pairwise(ordered) if a[0] < b[0])
    common = lambda a, b: sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(a, b, strict=False)))
    got = {(r.ord, r.i): r.lcp for r in suffix_dedup.repeats(df).collect()}
    assert got == {p: min(26, max(common(s, t) for q, t in places.items() if q != p)) for p, s in places.items()}


ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)


def brute_secrets(data):
    out = [(0, *m.span()) for m in ASSIGN.finditer(data) if len(m[2]) >= 12]
    out += [(1, *m.span()) for m in re.finditer(rb"AKIA[A-Z0-9]+", data) if len(m[0]) >= 18]
    return sorted(out + [(2, *m.span()) for m in re.finditer(rb"[0-9a-f]+", data) if len(m[0]) >= 16])


def test_secret_automaton_matches_regexes():
    scanner = secret_scan.Scanner(secret_scan.RULES)
    rnd = random.Random(1)
    parts = ["token", "secret", "=", ":", " ", '"', "'", "abc", "AKIA", "ABCDEFGHIJ1234", "0123456789abcdef", "password", "passwd", "api_key", "apikey", "API_KEY", "é", "\n", "-", "xyz123", "Token", "==", "...", "KEY"]
    for _ in range(4000):
        data = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))).encode()
        assert [s for s in scanner.spans(data) if s[0] < 3] == brute_secrets(data), data
    kinds = lambda s: [scanner.rules[k].kind for k, _, _ in scanner.spans(s)]
    assert kinds(b"x ghp_" + b"a1B2" * 9) == ["github"] and kinds(b"-----BEGIN RSA PRIVATE KEY-----") == ["private_key"]
    assert kinds(b"https://user:hunter22@host/") == ["basic_url"] and kinds(b"xoxb-1234567890-abcdef") == ["slack"]


def test_secret_spans_are_code_points(spark):
    rows = [(1, "é token = 0123456789abcdef"), (2, None), (3, ""), (3, ""), (None, "é" * 70_000 + "deadbeefdeadbeef")]
    got = {(r.doc_id, r.spans): r for r in secret_scan.scan(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, spans int")).collect()}
    one = got[(1, "assign:2:26,hex:10:26")]
    assert (one.n_assign, one.n_access, one.n_hex, one.base_sha256) == (1, 0, 1, hashlib.sha256(b"assign:2:26,hex:10:26").hexdigest())
    assert (None, "hex:70000:70016") in got and (2, "") in got
    assert secret_scan.scan(spark.createDataFrame([], DOC)).count() == 0


def test_search_plans_have_no_cross_join(spark, sf):
    plan = maxscore.search_every_nth(spark.read.parquet(f"{sf}/embeddings.parquet"))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

