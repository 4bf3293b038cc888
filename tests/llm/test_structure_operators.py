"""Centroid clustering, suffix deduplication and conversation repair against brute force on small tables."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from skyloom.llm import conversations as talk
from skyloom.llm import queries, suffix_dedup
from skyloom.llm.centroids import cluster, largest, nearest_centroids
from skyloom.llm.suffix_dedup import equal_groups, remove_repeats, seeds_of

SF = "/root/testdata/sf0.001"
ODD_COLUMNS = "k1 long, key string, seed long, cluster int, `a.b` string, id long, bytes string, copy int, v string"
ODD_VALUES = (1, "k", 2, 3, "x", 4, "b", 9, "v")


def same(got, want):
    return sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("name", ["op11_centroid_clusters", "op13_conversation_repair"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert same([tuple(r) for r in queries.QUERIES[name](spark, SF).select(columns).collect()], want.fetchall())


# --- centroid clustering


def test_threshold_walk_is_exact():
    rng = np.random.default_rng(3)
    for dims, k, spread in ((64, 16, 40), (3, 5, 4), (1, 1, 2), (8, 16, 1)):
        vectors = rng.integers(-spread, spread + 1, (500, dims))
        centroids = rng.integers(-spread, spread + 1, (k, dims))
        centroids[-1] = centroids[0]  # a tie between numbers
        number, distance, _ = nearest_centroids(vectors, centroids)
        every = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (number == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    far = np.zeros((2, 64), dtype=np.int64)
    far[1] = 10 * np.arange(64)
    _, _, measured = nearest_centroids(np.repeat(far, 50, axis=0), far)
    assert measured <= 200
    edge = largest(64) - 1
    number, distance, _ = nearest_centroids(np.full((1, 64), edge), np.full((1, 64), -edge))
    assert number[0] == 0 and int(distance[0]) == 64 * (2 * edge) ** 2


def test_walk_stops_early():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-1000, 1000, (200, 2))
    _, _, measured = nearest_centroids(centroids[:100] + 1, centroids)
    assert measured < 100 * 200 / 4


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), str(i), v) for i, v in kept if i is not None)[:k]
    centroids = [list(v) for _, _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), o in zip(kept, of) if o == n]
            if own:
                centroids[n] = [sum(column) // len(own) for column in zip(*own)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, n, d in last:
        inertia[n] += d
    return [(i, n, d, inertia[n], sum(inertia.values()),
             hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, n, d in last]


def vector_table(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], *ODD_VALUES[:5], "t") for i, v in rows]
    return spark.createDataFrame(
        rows, "vec_id long, embedding array<double>, k1 long, key string, seed long, cluster int, `a.b` string, v string"
    ).repartition(3)


def clusters(df):
    out = cluster(df).collect()
    return [(r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia,
             hashlib.sha256(",".join(map(str, r.centroid)).encode()).hexdigest()) for r in out]


def test_clusters(spark):
    rng = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 64)))]
    rows += [(7, rows[7][1])] * 3 + [(8, rng.normal(size=64).tolist()), (None, rng.normal(size=64).tolist())]
    rows += [(100 + i, rows[0][1]) for i in range(5)]  # ties
    odd = [(200, None), (201, []), (202, [1.0] * 63), (203, [None] + [1.0] * 63), (204, [float("nan")] * 64),
           (205, [float("inf")] * 64), (206, [0.0] * 64)]
    assert same(clusters(vector_table(spark, rows + odd)), brute_clusters(rows + odd))
    assert same(clusters(vector_table(spark, rows[:5])), brute_clusters(rows[:5]))  # fewer vectors than centroids
    assert clusters(vector_table(spark, odd[:-1])) == []
    assert clusters(vector_table(spark, [(None, [1.0] * 64)])) == []
    assert clusters(vector_table(spark, [])) == []
    assert len(clusters(vector_table(spark, [(1, [1e9] * 64), (2, [1.0] * 64)]))) == 1  # beyond a long


# --- suffix deduplication


def brute_repeats(docs, length):
    texts = [(t or "").encode() for _, t in docs]
    count = Counter(b[p : p + length] for b in texts for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(docs, texts):
        gone = [False] * (len(b) + 1)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = [p for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1])]
        out.append((i, len(b), sum(gone), len(spans), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def repeats(spark, docs, length):
    table = spark.createDataFrame([(*d, *ODD_VALUES) for d in docs], f"doc_id long, text string, {ODD_COLUMNS}").repartition(3)
    found = remove_repeats(table, length).collect()
    for r in found:
        assert r.n_removed == sum(s.high - s.low for s in r.spans) and r.n_spans == len(r.spans)
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found]


def passages(seed):
    r = random.Random(seed)

    def some(n):
        return "".join(r.choice("abcdé ") for _ in range(n))

    shared = [some(60), some(47), some(41), "ab" * 60, some(20)]
    docs = [(1, None), (2, ""), (3, "x" * 300), (4, some(200)), (4, None), (None, some(90) + shared[0]), (None, shared[0] + some(30))]
    docs += [(i + 10, "".join(r.choice([some(r.randint(0, 50)), r.choice(shared)]) for _ in range(r.randint(1, 6)))) for i in range(50)]
    docs += [docs[20]] * 3  # repeated rows
    begin = some(45)
    return docs + [(200 + i, some(30) + begin[:38] + some(r.randint(0, 25))) for i in range(40)]


@pytest.mark.parametrize("small", [False, True])
def test_repeats(spark, monkeypatch, small):
    if small:  # several segments of a text, blocks of a seed and steps of a task
        for name, value in (("SEGMENT", 64), ("BLOCK", 4), ("STEP", 300)):
            monkeypatch.setattr(suffix_dedup, name, value)
    docs = passages(5)
    assert same(repeats(spark, docs, 40), brute_repeats(docs, 40))
    if small:
        assert same(repeats(spark, passages(6), 23), brute_repeats(passages(6), 23))


def test_repeats_of_odd_tables(spark):
    assert repeats(spark, [], 400) == []
    small = [(1, None), (None, ""), (2, "short")]
    assert same(repeats(spark, small, 400), brute_repeats(small, 400))
    exact = [(1, "q" * 399), (2, "q" * 399), (3, "é" * 200), (3, "é" * 200), (4, "z" * 401)]
    assert same(repeats(spark, exact, 400), brute_repeats(exact, 400))
    r = random.Random(2)
    long = "".join(r.choice("abcdefgh ") for _ in range(400_000))
    got = {g[0]: g[1:4] for g in repeats(spark, [(1, long), (2, "0" + long[1000:3000] + "1"), (3, long[-399:])], 400)}
    assert got == {1: (400_000, 2000, 1), 2: (2002, 2000, 1), 3: (399, 0, 0)}


def test_passes_and_seeds():
    r = np.random.default_rng(4)
    words = [r.integers(0, 3, 500).astype(np.uint64) for _ in range(4)]
    group = r.integers(0, 5, 500)
    keys = list(zip(group, *words))
    got, times = equal_groups(words, group), Counter(keys)
    for a, b in itertools.combinations(range(200), 2):
        assert (keys[a] == keys[b]) == (got[a] == got[b] and got[a] >= 0)
    assert all((got[i] < 0) == (times[keys[i]] == 1) for i in range(500))
    data = bytes(r.integers(97, 101, 700).astype(np.uint8))
    at, low, high, seed, _ = seeds_of(data, 100, 25)
    assert low[0] == 0 and high[-1] == 600 and (low[1:] == high[:-1] + 1).all()
    assert ((at >= high) & (at + 25 <= low + 100)).all()  # the seed lies in each string of its chunk


# --- conversation repair


def viterbi(symbols):
    """Cost and audit over the states of the grammar, an independent solution."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserted(states):
        for _ in range(2):
            for s, (c, a) in list(states.items()):
                states[after[s]] = min(states.get(after[s], (c + 5, a + "I")), (c + 5, a + "I"))
        return states

    states = {0: (0, "")}
    for x in symbols:
        new, broken = {}, 5 if x.isupper() else 0
        for s, (c, a) in inserted(states).items():
            ways = [(s, c + 2, "D")]
            if x != "d":
                ways.append((after[s], c + 1 + broken, "R"))
                if (s, x.lower()) in ((0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")):
                    ways.append((1 if x.lower() == "s" else after[s], c + broken, "K"))
            for t, cost, letter in ways:
                new[t] = min(new.get(t, (cost, a + letter)), (cost, a + letter))
        states = new
    states = inserted(states)
    return min(states[s] for s in (0, 3) if s in states)


def every_edit(symbols):
    """The same by trying all edits."""
    best = [(10**9, "")]
    after = {0: 2, 1: 2, 2: 3, 3: 2}

    def go(i, s, cost, audit, run):
        if (cost, audit) >= best[0] and cost > best[0][0]:
            return
        if i == len(symbols) and s in (0, 3):
            best[0] = min(best[0], (cost, audit))
        if run < 2:
            go(i, after[s], cost + 5, audit + "I", run + 1)
        if i < len(symbols):
            x = symbols[i]
            go(i + 1, s, cost + 2, audit + "D", 0)
            if x != "d":
                broken = 5 if x.isupper() else 0
                go(i + 1, after[s], cost + 1 + broken, audit + "R", 0)
                if (s, x.lower()) in ((0, "s"), (0, "u"), (1, "u"), (2, "a"), (3, "u")):
                    go(i + 1, 1 if x.lower() == "s" else after[s], cost + broken, audit + "K", 0)

    go(0, 0, 0, "", 0)
    return best[0]


def test_alignment():
    for n in range(4):
        for symbols in map("".join, itertools.product("suaxSUAd", repeat=n)):
            assert talk.align(symbols) == every_edit(symbols) == viterbi(symbols), symbols
    r = random.Random(1)
    for _ in range(400):
        symbols = "".join(r.choice("suauauauauauaxSUAd") for _ in range(r.randint(4, 40)))
        assert talk.align(symbols) == viterbi(symbols), symbols


def test_chained_segments():
    r = random.Random(2)
    for _ in range(400):
        symbols = "".join(r.choice("suauauauauauaxSUAd") for _ in range(r.randint(2, 40)))
        width, states = r.randint(1, 7), {0: (0, "")}
        for x in range(0, len(symbols), width):
            new = {}
            for (a, b), (cost, audit) in talk.transfers(symbols[x : x + width]).items():
                if a in states:
                    way = (states[a][0] + cost, states[a][1] + audit)
                    new[b] = min(new.get(b, way), way)
            states = new
        assert min(states[s] for s in (0, 3) if s in states) == viterbi(symbols)


def brute_repair(rows):
    white, out = " \t\n\x0b\x0c\r", []
    for conv in {r[0] for r in rows}:
        turns = []
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        for turn, role, text in sorted(own, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode())):
            place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            harm = zlib.crc32(place.encode()) % 20
            text = "" if harm == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if harm == 2 else text
            role = "user" if harm == 4 else role
            turns += [(turn, role, text)] * {0: 0, 3: 2}.get(harm, 1)
        seen, symbols, faults = set(), "", Counter()
        for _, role, text in turns:
            bare = text.strip(white)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            symbol = role[:1] if role[:1] in ("s", "u", "a") else "x"
            symbols += "d" if fault in ("blank", "duplicate") else symbol.upper() if fault else symbol
        cost, audit = viterbi(symbols)
        lines, at = [], 0
        for letter in audit:
            expected = "user" if not lines or lines[-1][0] in "sa" else "assistant"
            if letter == "I":
                lines.append(f"{expected}:")
                continue
            if letter != "D":
                lines.append(f"{turns[at][1] if letter == 'K' else expected}:{turns[at][2]}")
            at += 1
        numbers = [t for t, *_ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        text = "\n".join(lines)
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest(), text))
    return out


def conversation_rows():
    r, rows = random.Random(7), []
    for conv in [*range(60), None]:
        n = 150 if conv in (3, None) else r.randint(1, 9)
        for turn in range(n):
            role = r.choice(["user", "assistant", "system", "tool", "", None, "User"]) if r.random() < 0.3 else ("user", "assistant")[turn % 2]
            text = r.choice(["Yes.", "No", "", " \n", None, "Why? \t", "é…", "Ok!\r\n"]) if r.random() < 0.5 else f"Turn {turn}."
            rows.append((conv, None if r.random() < 0.05 else turn + (turn > 4), role, text))
    rows += rows[:20]  # repeated rows
    return rows + [(500 + i, i, "user", "Alone.") for i in range(40)]  # some lose all turns


def repairs(spark, rows):
    table = spark.createDataFrame([(*x, *ODD_VALUES) for x in rows], f"conv_id long, turn long, role string, text string, {ODD_COLUMNS}")
    return [tuple(r) for r in talk.repair(talk.damaged(talk.turns_of(table.repartition(3))), texts=True).collect()]


@pytest.mark.parametrize("segment", [512, 5])
def test_repair(spark, monkeypatch, segment):
    monkeypatch.setattr(talk, "SEGMENT", segment)
    rows = conversation_rows()
    got, want = repairs(spark, rows), brute_repair(rows)
    assert same(got, want)
    assert any(g[7] == "" and g[8] == hashlib.sha256(b"").hexdigest() for g in got)


def test_repair_of_odd_tables(spark):
    assert repairs(spark, []) == []
    long = [(1, i, ("user", "assistant")[i % 2], "word " * 50_000 + ".") for i in range(4)]
    assert same(repairs(spark, long), brute_repair(long))
    sound = spark.createDataFrame([("x", 1, "user", "Hi."), ("x", 2, "assistant", "Yes.")], "conv_id string, turn long, role string, text string")
    assert [tuple(r) for r in talk.repair(talk.turns_of(sound), texts=True).collect()] == [
        ("x", 0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest(), "user:Hi.\nassistant:Yes.")
    ]
