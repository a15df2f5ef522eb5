"""Operators 11 to 13 against brute force, and on nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from podelta.llm import conversation_repair, mixing, orchard, pii, recompression, simhash

SF = "/root/testdata/sf0.001"


# --- 11 --------------------------------------------------------------------
def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(f, text)
        out += [(conv, turn, "user" if f == 4 else role, text)] * {0: 0, 3: 2}.get(f, 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def brute_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Every edit sequence with up to two inserts in a row."""
    faults, best = brute_faults(rows), None

    def walk(i, cost, audit, out, inserts):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows):
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
        else:
            _, _, role, text = rows[i]
            if faults[i] not in ("blank", "duplicate"):
                more = faults[i] == "truncated"
                walk(i + 1, cost + more, audit + "K", [*out, (role, text)], 0)
                for r in ("user", "assistant"):
                    walk(i + 1, cost + more + 2, audit + "R", [*out, (r, text)], 0)
            walk(i + 1, cost + 3, audit + "D", out, 0)
        if inserts < 2:
            for r in ("user", "assistant"):
                walk(i, cost + 2, audit + "I", [*out, (r, "")], inserts + 1)

    walk(0, 0, "", [], 0)
    return best


def brute_conversation(rows):
    faults = brute_faults(rows)
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    cost, audit, text = brute_repair(rows)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


CONV = "conv_id long, turn long, role string, text string, again string, here string, audit string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], CONV)


def repaired(spark, rows):
    df = conversations(spark, rows)
    return conversation_repair.repair(conversation_repair.damage(df), df)


def test_repair_matches_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None, "User", "umpire"])
            text = rng.choice(["Hi.", "Hi.", "No end", " \t", "", None, "Why? ", "a.b", "ends!\n", "é."])
            rows += [(conv, rng.choice([turn, turn, turn, None, turn + 3]), role, text)] * rng.choice([1, 1, 1, 2])
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes.")]
    got = {r[0]: tuple(r)[1:] for r in repaired(spark, rows).collect()}
    assert got.keys() == {r[0] for r in rows}
    for conv in got:
        damaged = brute_damage([r for r in rows if r[0] == conv])
        if len(damaged) <= 5:
            assert got[conv] == brute_conversation(damaged), damaged


def test_weights_order_as_pairs_over_many_blocks():
    """Weights cut into ranks agree with plain (cost, audit) pairs, also where paths never meet again."""
    rng = random.Random(9)
    moves = {"s": [(0, 1)], "u": [(0, 2), (1, 2), (3, 2)], "a": [(2, 3)]}

    def plain(rows):
        def insert(at):
            for _ in range(2):
                at = dict(at)
                for s, t in moves["u"] + moves["a"]:
                    if s in at:
                        c = (at[s][0] + 2, at[s][1] + "I")
                        at[t] = min(at.get(t, c), c)
            return at

        at = {0: (0, "")}
        for initial, gone, short in rows:
            at, new = insert(at), {}
            for s, (c, w) in at.items():
                options = [(s, c + 3, "D")]
                for r, steps in moves.items() if not gone else ():
                    options += [(t, c + short + 2 * (r != initial), "K" if r == initial else "R")
                                for f, t in steps if f == s and (r == initial or r != "s")]
                for t, cost, letter in options:
                    new[t] = min(new.get(t, (cost, w + letter)), (cost, w + letter))
            at = new
        at = insert(at)
        return min(at[s] for s in (0, 3) if s in at)

    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    for kind in ("suat", "ua", "u", "a", "uuaa"):
        for n in (1, 2, 31, 32, 33, 64, 65, 200):
            rows = [(kind[i % 4] if kind == "uuaa" else rng.choice(kind), kind != "uuaa" and rng.random() < 0.2, rng.random() < 0.2) for i in range(n)]
            job = conversation_repair.Repair()
            for initial, gone, short in rows:
                job.add(names[initial], "x", gone, short)
            assert job.result()[:2] == plain(rows), (kind, n)


def test_repaired_rows_spell_the_hash(spark):
    given = spark.read.parquet(f"{SF}/conversations.parquet")
    damaged = conversation_repair.damage(given)
    result = conversation_repair.repair(damaged, given)
    rows = conversation_repair.repaired_rows(damaged, result).collect()
    for r in result.collect():
        mine = sorted((x for x in rows if x.conv_id == r.conv_id), key=lambda x: x.place)
        assert [x.place for x in mine] == list(range(1, len(mine) + 1))
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in mine).encode()).hexdigest() == r.repaired_sha256


def test_repair_edge_cases(spark):
    assert repaired(spark, []).collect() == []
    dropped = next(c for c in itertools.count() if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    plain = next(c for c in itertools.count() if all(zlib.crc32(f"{c}:{t}".encode()) % 20 > 4 for t in range(3)))
    long = "word " * 200_000 + "end."
    got = {r.conv_id: r for r in repaired(spark, [(dropped, 0, "user", "Hi."), (plain, 0, "user", long), (plain, 1, "assistant", long),
                                                  (plain, 2, None, None)]).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got[dropped])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    r = got[plain]
    assert (r.cost, r.audit, r.blank, r.illegal) == (3, "KKD", 1, 1)
    assert r.repaired_sha256 == hashlib.sha256(f"user:{long}\nassistant:{long}".encode()).hexdigest()


# --- 12 --------------------------------------------------------------------
DOCS = "doc_id long, text string, bucket string, names string, places string, hash string, kept string, borders string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d", "e", "f") for i, t in rows], DOCS)


def brute_dedup(rows, size=13):
    least, out = {}, []
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - size + 1) if d is not None else ():
            key = tuple(w[i : i + size])
            least[key] = min(least.get(key, d), d)
    for d, w in split:
        gone = {j for i in range(len(w) - size + 1) if d is not None and least[tuple(w[i : i + size])] < d for j in range(i, i + size)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def got_dedup(spark, rows, **options):
    return sorted((tuple(r) for r in recompression.dedup(documents(spark, rows), **options).collect()), key=str)


@pytest.mark.parametrize("alphabet", [1, 2, 4, 1000])
def test_dedup_matches_brute_force(spark, alphabet):
    rng = random.Random(alphabet)
    passages = [[f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    rows = []
    for d in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"w{rng.randrange(alphabet)}" for _ in range(rng.randrange(30))] + rng.choice(passages)[rng.randrange(4):]
        rows.append((d * 7 % 60, rng.choice([" ", "\n", "\t "]).join(words)))
    # Small blocks, pieces and buckets: their borders fall inside passages.
    assert got_dedup(spark, rows, block=200, bucket_chars=2000, piece=9) == brute_dedup(rows)
    assert got_dedup(spark, rows) == brute_dedup(rows)


def test_window_names_depend_on_the_words_alone():
    rng = random.Random(3)
    for alphabet in (1, 2, 3, 40):
        words = [b"%d" % rng.randrange(alphabet) for _ in range(3000)]
        for _ in range(20):
            a, b, n = rng.randrange(2900), rng.randrange(2900), rng.randrange(13, 60)
            words[b : b + n] = words[a : a + n]
        table = recompression.Words()
        ids = np.array([table[w] for w in words])
        names = recompression.window_names(table.symbols()[:, ids], np.arange(len(words) - 12))
        by = {}
        for i in range(names.shape[1]):
            by.setdefault(tuple(words[i : i + 13]), set()).add(tuple(names[:, i].tolist()))
        assert all(len(n) == 1 for n in by.values()) and len({n for s in by.values() for n in s}) == len(by)


def test_dedup_edge_cases(spark):
    assert got_dedup(spark, []) == []
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(13))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, a), (9, "x " + a), (9, a + " y"), (9, a + " y"), (None, a), (None, a), (12, b[3:]),
            (11, b), (13, b + " " + b), (20, "é " * 30), (21, "é " * 13 + "日本"), (22, "z\x00" + a)]
    assert got_dedup(spark, rows) == brute_dedup(rows)
    long = " ".join(f"t{i % 50_000}" for i in range(300_000))
    got = got_dedup(spark, [(1, long), (2, "new " + long[3:])], piece=1 << 16)
    assert [r[1:3] for r in got] == [(300_000, 0), (300_000, 299_999)] and got[1][3] == "new"


def test_a_hot_passage_is_one_entry_a_block(spark):
    """A passage in every document: within a block only the least document's windows go on."""
    words = recompression.Words()
    ids = [np.array([words[b"p%d" % i] for i in range(30)])] * 50
    rows = list(recompression._block(words, ids, list(range(50)), [7] * 50, [0] * 50, 4, 13))
    assert sum(len(r[1]) // 8 for r in rows if r[0] >= 0) == 18


# --- 13 --------------------------------------------------------------------
def brute_clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    at = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(at))

    for _ in range(rounds):
        mine = {}
        for _, v in kept:
            mine.setdefault(near(v)[1], []).append(v)
        at = [[sum(x) // len(mine[c]) for x in zip(*mine[c])] if c in mine else at[c] for c in range(len(at))]
    out = [(i, near(v)) for i, v in kept]
    total = [sum(d for _, (d, c) in out if c == n) for n in range(len(at))]
    return sorted(((i, c, d, total[c], sum(total), hashlib.sha256(",".join(map(str, at[c])).encode()).hexdigest())
                   for i, (d, c) in out), key=str)


VECTORS = "vec_id long, embedding array<double>, key string, v string, cluster string, distance string"


def got_clusters(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], VECTORS)
    return sorted((tuple(r) for r in orchard.with_inertia(*orchard.cluster(df, **options)).collect()), key=str)


def test_clusters_match_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 64)))]
    rows += [(500 + i, (v / 2048).tolist()) for i, v in enumerate(rng.integers(-2, 3, size=(80, 64)).astype(float))]  # many ties
    rows += [(700, rows[0][1]), (0, rows[0][1]), (None, rows[5][1]), (701, None), (702, [1.0] * 63), (703, [1.0] * 65), (704, []),
             (705, [float("nan")] + [0.0] * 63), (706, [float("inf")] * 64), (707, [None] + [0.0] * 63)]
    assert got_clusters(spark, rows) == brute_clusters(rows)


def test_clusters_of_few_vectors(spark):
    assert got_clusters(spark, []) == []
    rows = [(1, [0.5] * 64), (2, [0.5] * 64), (3, [-0.25] * 64)]
    assert got_clusters(spark, rows) == brute_clusters(rows)
    with pytest.raises(Exception, match="component"):
        got_clusters(spark, [(1, [1e9] * 64)])


def test_orchard_search_is_exact_and_prunes():
    rng = np.random.default_rng(4)
    for k, scale in ((1, 9), (2, 9), (60, 1000), (60, 2)):
        centroids = rng.integers(-scale, scale + 1, size=(k, 4))
        centroids[k // 2:] = centroids[: k - k // 2]  # equal centroids: the smaller number wins
        x = rng.integers(-scale, scale + 1, size=(500, 4))
        nearest, best, computed = orchard.search(x, centroids, orchard.neighbour_lists(centroids))
        d = ((x[:, None] - centroids) ** 2).sum(axis=2)
        assert (nearest == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    far = np.repeat(np.arange(50) * 1000, 20)[:, None] + rng.integers(0, 9, size=(1000, 1))
    *_, computed = orchard.search(far, np.arange(50)[:, None] * 1000, orchard.neighbour_lists(np.arange(50)[:, None] * 1000))
    assert computed < 0.6 * far.size * 50


# --- columns that clash with working names, ties ------------------------------
CLASH = "doc_id long, text string, source string, Rate string, place string, __rate string, chosen string, spans string, __spans string, key string"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, s, "r", "p", "q", "c", "s", "u", "k") for i, t, s in rows], CLASH)


def test_clashing_columns_pass_unchanged(spark):
    text = "Write to ann@example.org about the many things of this long enough text"
    rows = clashing(spark, [(1, text, "a"), (2, "other words stand in this text", "b"), (None, None, None)])
    rest = ("r", "p", "q", "c", "s", "u", "k")
    mixed = mixing.mix(rows, weights={"a": 1.0, "b": 1.0}, total=40)
    assert mixed.columns == rows.columns and {tuple(r)[3:] for r in mixed.collect()} == {rest}
    numbered = mixing.mix(rows, weights={"a": 1.0, "b": 1.0}, total=40, copy="place")
    assert numbered.columns == [c for c in rows.columns if c != "place"] + ["place"] and numbered.agg({"place": "min"}).first()[0] == 0
    kept = simhash.keep_one(rows)
    assert kept.columns == rows.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    train = spark.read.parquet(f"{SF}/documents.parquet")
    cut = pii.redact(rows, booster=pii.train(train, "text"))
    assert cut.columns == rows.columns
    got = {r.doc_id: r for r in cut.collect()}
    assert got[1].text == text.replace("ann@example.org", "[EMAIL]") and all(tuple(r)[3:] == rest for r in got.values())


def test_ties_keep_the_least_row(spark):
    rows = [(1, "same words in the same text", s) for s in ("b", "a", None, "c")] + [(2, None, "y"), (2, "", "x")]
    for order in (rows, rows[::-1]):
        got = sorted((r.doc_id, r.text, r.source) for r in simhash.keep_one(clashing(spark, order).repartition(5)).collect())
        assert got == [(1, "same words in the same text", "a"), (2, "", "x")]


def test_sorting_a_buckets_names_needs_little_beside_them():
    import tracemalloc
    names = np.random.default_rng(1).integers(0, 1 << 63, 1 << 20, dtype=np.uint64)[np.random.default_rng(2).integers(0, 1 << 20, 1 << 21)] * np.uint64(2)
    docs = np.random.default_rng(3).integers(0, 1000, len(names)).astype(np.int32)
    least = np.full(1 << 21, 1000, np.int32)
    at = np.unique(names, return_inverse=True)[1]
    np.minimum.at(least, at, docs)
    tracemalloc.start()
    try:
        got = recompression._least(names, docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (got == (docs > least[at])).all()
    assert peak < 8 * len(names)
