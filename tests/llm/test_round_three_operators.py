"""Operators 11 to 13 against brute force, with the odd rows of each table."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tidemart.llm import queries, ranked_search, turn_repair, vector_dedup

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, id long, place int"


# ------------------------------------------------------------- 11: vectors
def united(n: int, links: list[tuple[int, int]]) -> list[int]:
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def vector_brute(rows: list[tuple]) -> dict:
    """(n_links, component_id, kept) of every different row, from all pairs."""
    rows = sorted(set((i, None if v is None else tuple(v), x) for i, v, x, *_ in rows), key=lambda r: (r[0] is not None, r[0] or 0, str(r[1:])))
    good = [k for k, (i, v, x) in enumerate(rows)
            if i is not None and x is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    links = []
    for a in range(len(good)):
        for b in range(a):
            (_, v, x), (_, w, y) = rows[good[a]], rows[good[b]]
            if x == y and len(v) == len(w):
                v, w = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                    links.append((good[a], good[b]))
    count = Counter(i for pair in links for i in pair)
    root = united(len(rows), links)
    least = {r: min(rows[k][0] for k in range(len(rows)) if root[k] == r) for r in {root[k] for k in good}}
    return sorted(((i, count[k], least.get(root[k], i) if k in good else i) for k, (i, _, _) in enumerate(rows)), key=str)


def some_vectors(n: int, seed: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    heads = draw.standard_normal((max(1, n // 6), 24))
    out = []
    for i in range(n):
        v = heads[draw.integers(len(heads))] + draw.choice([0.0, 0.1, 0.35]) * draw.standard_normal(24)
        out.append((i * 3, [float(np.float32(x)) for x in v], int(draw.integers(3)), i, 0))
    return out


def near_rows(spark, rows, **options):
    found = vector_dedup.near_vectors(spark.createDataFrame(rows, VECTORS), **options).collect()
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in found)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str)


def test_near_vectors_equal_brute_force_with_odd_rows(spark):
    rows = some_vectors(300, 1)
    v = rows[0][1]
    rows += [(1, v, rows[0][2], 0, 0), (1, v, rows[0][2], 0, 0), (2, v, None, 0, 0), (None, v, 0, 0, 0), (4, None, 0, 0, 0), (5, [], 0, 0, 0),
             (7, [0.0] * 24, 0, 0, 0), (8, [float("nan")] * 24, 0, 0, 0), (10, [None] * 24, 0, 0, 0), (11, v[:12], rows[0][2], 0, 0),
             (13, [float("inf")] + v[1:], 0, 0, 0), (14, [1e-30 * x for x in v], rows[0][2], 0, 0), (3, v, rows[0][2], 0, 0), (17, [2.0], 1, 0, 0),
             (19, [5.0], 1, 0, 0)]
    want = vector_brute(rows)
    assert any(n > 1 for _, n, _ in want)
    got = near_rows(spark, rows)
    assert [g[:2] for g in got if g[0] != 8] == [w[:2] for w in want if w[0] != 8]  # a NaN is no equal key for Python's set
    assert [g for g in got if g[0] != 8] == [w for w in want if w[0] != 8]


def test_near_vectors_of_an_empty_table(spark):
    assert near_rows(spark, []) == []


def test_small_windows_find_nearly_all_links_and_no_other(spark):
    """A label far larger than the window: passes are added, recall stays above 0.9, components are right."""
    rows = [(i, v, 0, 0, 0) for i, v, *_ in some_vectors(900, 5)]
    want = vector_brute(rows)
    got = near_rows(spark, rows, window=24)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) > 0.9 * sum(w[1] for w in want)
    assert np.mean([g[2] == w[2] for g, w in zip(got, want, strict=True)]) > 0.99


def test_blocks_of_one_order_meet_at_their_edges(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 32)
    rows = [(i, v, 0, 0, 0) for i, v, *_ in some_vectors(200, 6)]
    want = vector_brute(rows)
    got = near_rows(spark, rows, window=32, recall=0.999999)
    assert sum(g[1] for g in got) > 0.97 * sum(w[1] for w in want)


def test_copies_are_one_class(spark):
    v = some_vectors(1, 3)[0][1]
    assert near_rows(spark, [(i, v, 1, 0, 0) for i in range(5, 45)]) == sorted(((i, 39, 5) for i in range(5, 45)), key=str)


def test_op11_has_one_row_per_vector(spark):
    rows = duckdb.sql(f"select vec_id, embedding, label from '{SMALL}/embeddings.parquet'").fetchall()
    found = queries.op11_vector_dedup(spark, SMALL).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == vector_brute(rows)


# ------------------------------------------------------------- 12: turns
def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if case == 1 else re.sub("[.!?]", "", x) if case == 2 else x
        r = "user" if case == 4 else r
        out += [(c, t, r, x)] * (0 if case == 0 else 2 if case == 3 else 1)
    return out


def follows(state: str, initial: str) -> str | None:
    return {"0s": "s", "0u": "u", "su": "u", "ua": "a", "au": "u"}.get(state + initial)


def cheapest(rows: list[tuple]) -> tuple:
    """The expected columns of one conversation's (turn, role, text) rows: least (cost, audit) of every suffix from every state."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faults = set(), []
    for _, r, x in rows:
        core = re.sub(r"[\x20\x09-\x0D]+\Z", "", x)
        faults.append("blank" if not core else "duplicate" if (r, x) in seen else "truncated" if core[-1] not in ".!?" else None)
        seen.add((r, x))

    def inserted(v):
        for _ in range(4):
            v = {s: min([v[s], *((v[z][0] + 3, "I" + v[z][1], ((role, ""), v[z][2]))
                                 for role in ("user", "assistant") if (z := follows(s, role[0])))]) for s in "0sua"}
        return v

    never = (10 ** 9, "", ())
    after = inserted({"0": (0, "", ()), "a": (0, "", ()), "s": never, "u": never})
    for (_, r, x), fault in zip(reversed(rows), reversed(faults), strict=True):
        extra, here = 3 * (fault == "truncated"), {}
        for s in "0sua":
            options = [(after[s][0] + 4, "D" + after[s][1], after[s][2])]
            if fault not in ("blank", "duplicate"):
                for role, letter, price in ((r, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if z := follows(s, role[:1]):
                        options.append((after[z][0] + price + extra, letter + after[z][1], ((role, x), after[z][2])))
            here[s] = min(options)
        after = inserted(here)
    cost, audit, made = after["0"]
    lines = []
    while made:
        lines.append(":".join(made[0]))
        made = made[1]
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def turns_brute(rows) -> dict:
    convs = {r[0]: [] for r in rows}
    for c, *row in damage(rows):
        convs[c].append(tuple(row))
    return {c: cheapest(v) for c, v in convs.items()}


def random_turns(seed: int, convs: int, longest: int) -> list[tuple]:
    pick = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    texts = ["Yes.", "No!", "and then", " ", "", None, "What?\n", "x.", "end .  ", "Grüße.", "　"]
    return [(None if c == 0 else c, None if pick.random() < 0.05 else t + pick.choice([0, 0, 0, 1, 5]), pick.choice(roles),
             pick.choice(texts) if pick.random() < 0.3 else f"text {pick.randint(0, 50)}{pick.choice(['.', '!', ''])}")
            for c in range(convs) for t in range(pick.randint(1, longest))]


def op12_rows(spark, rows, tmp_path, **options):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    return {r["conv_id"]: tuple(r)[1:] for r in queries.op12_turn_repair(spark, str(tmp_path)).collect()}


@pytest.mark.parametrize("chunk_rows, fixups", [(256, 3), (3, 3), (1, 0)])
def test_repair_equals_search_over_all_edits(spark, tmp_path, monkeypatch, chunk_rows, fixups):
    """In one chunk, in chunks that are fixed up, and in chunks composed by doubling."""
    monkeypatch.setattr(turn_repair, "FIXUPS", fixups)
    plain = turn_repair.repair
    monkeypatch.setattr(turn_repair, "repair", lambda turns: plain(turns, chunk_rows=chunk_rows))
    rows = random_turns(chunk_rows, 40, 14)
    assert op12_rows(spark, rows, tmp_path) == turns_brute(rows)


def test_rows_that_never_converge(spark, tmp_path, monkeypatch):
    """Blank rows only shift the costs and foreign roles only swap the states: no fix-up pass settles them."""
    plain = turn_repair.repair
    monkeypatch.setattr(turn_repair, "repair", lambda turns: plain(turns, chunk_rows=4))
    rows = [(1, t, "user" if t == 0 else "x", f"a {t}." if t < 40 else " ") for t in range(80)] + [(2, t, "tool", f"b {t}.") for t in range(61)]
    assert op12_rows(spark, rows, tmp_path) == turns_brute(rows)


def test_repair_keeps_rows_of_a_legal_conversation_and_deletes_blank_ones(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "q?"), (1, 2, "assistant", "a."), (2, 0, "user", " ")]
    fixed = turn_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [tuple(r)[2:] for r in fixed.turns.orderBy("conv_id", "place").collect()] == [("system", "s."), ("user", "q?"), ("assistant", "a.")]
    assert {r["conv_id"]: (r["cost"], r["blank"]) for r in fixed.report.collect()} == {1: (0, 0), 2: (4, 1)}


def test_op12_with_no_rows(spark, tmp_path):
    assert op12_rows(spark, [], tmp_path) == {}


def test_op12_on_the_small_table(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SMALL}/conversations.parquet'").fetchall()
    assert {r["conv_id"]: tuple(r)[1:] for r in queries.op12_turn_repair(spark, SMALL).collect()} == turns_brute(rows)


# ------------------------------------------------------------- 13: search
def search_brute(docs, items, k=20):
    fold = str.maketrans(ranked_search.UPPER, ranked_search.LOWER)

    def terms(text):
        return re.findall(ranked_search.TERM, (text or "").translate(fold))

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    documents, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        asked, scores = terms(text), []
        for i, c, n in held:
            m = 75 + 25 * n * documents // total
            scores.append((sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                               for t in asked if c[t]), i))
        scores = sorted((x for x in scores if x[0] > 0), key=lambda x: (-x[0], x[1] is not None, x[1] or 0))
        out += [(item, rank, i, s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def found_rows(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, term int, number int")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, key int")
    return sorted((tuple(r) for r in ranked_search.ranked_search(d, b, **options).collect()), key=str)


def random_texts(seed: int, n: int, length: int) -> list[str]:
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "ÜNÏ", "don't", "a_b", "x-y", "The", "the", "日本", " nbsp"]
    return [" ".join(pick.choice(vocabulary[:pick.randint(2, len(vocabulary))]) for _ in range(pick.randint(0, length))) for _ in range(n)]


def test_search_equals_brute_force(spark, monkeypatch):
    """Small bundles, trees and blocks, so that pruning, floors and merging all take part."""
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(ranked_search, "TREE_CELLS", 3000)
    docs = list(enumerate(random_texts(1, 400, 40))) + [(900, None), (901, ""), (902, "... !"), (None, "w1 w2"), (None, "w1 w2"), (3, "w3 w3"), (3, "w3 w3")]
    docs += [(1000 + i, "w1 w2 w50") for i in range(60)]  # ties beyond k
    items = list(enumerate(random_texts(2, 20, 15))) + [(50, None), (51, ""), (52, "nowhere"), (53, "w1"), (53, "w1"), (53, "W2 w2"), (None, "the The")]
    assert found_rows(spark, docs, items) == search_brute(docs, items)


def test_search_with_a_long_text_and_few_documents(spark):
    docs = [(1, " ".join(f"t{i % 5000}" for i in range(60_000))), (2, "t1 t2"), (3, "other")]
    items = [(1, "t1 t2 t3"), (2, " ".join(f"t{i}" for i in range(3000)))]
    assert found_rows(spark, docs, items, k=2) == search_brute(docs, items, 2)


def test_search_of_nothing(spark):
    assert found_rows(spark, [], [(1, "a")]) == [] and found_rows(spark, [(1, "a")], []) == []


def test_pruning_leaves_node_pairs_out():
    """Documents in groups of words of their own: items meet the leaves of their group alone."""
    words = [[f"g{g}w{i}" for i in range(10)] for g in range(16)]
    vocabulary = sorted(w for g in words for w in g)
    index = {w: i for i, w in enumerate(vocabulary)}
    dense = np.zeros((512, len(vocabulary)))
    for d in range(512):
        dense[d, [index[w] for w in words[d % 16]]] = 1 + d % 7
    block = {"keys": list(range(16)), "vocabulary": vocabulary, "floors": np.ones(16, np.int64),
             "rows": np.repeat(np.arange(16), 10), "columns": np.array([index[w] for g in words for w in g]), "values": np.full(160, 3)}
    items = ranked_search._Items(block, 5)
    met = []
    offer = items.offer
    items.offer = lambda chosen, scores, keys: (met.append(scores.size), offer(chosen, scores, keys))
    ranked_search._Documents(dense, list(range(512))).search(items)
    assert sum(met) < 16 * 512 / 8
    assert all(len(b) == 5 for b in items.best)


def test_op13_equals_its_sql_on_the_small_table(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    found = queries.op13_ranked_search(spark, SMALL)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(con.sql(ranked_search.SQL).fetchall())
