"""Operators 5, 7 and 10, and the pipeline."""

import collections
import random

import numpy as np
import pytest
from llm_data import EDGES, docs_of, words
from pyspark.sql import functions as F

from tidemart.llm import components, kernels, near_dedup, quote_links, suffix_dedup


# ---------------------------------------------------------- words and hashes
def test_word_hashes_are_of_single_words():
    texts = ["Ab cd", "", "  ab\tCD\n", "ab", "cd!", "\x0b!\x0c", "AB é"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    got, first = kernels.word_hashes(data, offsets)
    assert np.diff(first).tolist() == [2, 0, 2, 1, 1, 1, 2]
    assert got[0] == got[2] == got[4] == got[7] and got[1] == got[3] and len(set(got.tolist())) == 5
    bare, first = kernels.word_hashes(data, offsets, strip=True)
    assert np.diff(first).tolist() == [2, 0, 2, 1, 1, 0, 2] and bare[5] == bare[1]


# ------------------------------------------------------------ 5: near-dedup
def _sets(rows):
    out = {}
    for i, t, *_ in rows:
        w = [x for x in "".join(c.lower() if c.isascii() else c for c in t or "").translate({k: 32 for k in range(9, 14)}).split(" ") if x]
        out.setdefault(i, []).append(frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)] if w else ()))
    return out


def _groups(rows, percent):
    sets = {(i, k): s for i, v in _sets(rows).items() if i is not None for k, s in enumerate(v)}
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, _), a in sets.items():
        for (j, _), b in sets.items():
            if i < j and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}


def _edited(base, seed, share):
    pick = random.Random(seed)
    return [w if pick.random() > share else f"e{seed}x{k}" for k, w in enumerate(base)]


@pytest.mark.parametrize("percent", [80, 85])
def test_groups_equal_brute_force(spark, percent, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)  # several blocks for each bucket
    rows = []
    for g in range(6):
        base = words(g, 150)
        rows += [(1000 * g + k, " ".join(_edited(base, 1000 * g + k, 0.002 * (k % 25)))) for k in range(40 if g < 2 else 6)]
    rows += [(9000 + k, rows[3][1]) for k in range(5)] + [(9100, "just four words here"), (9101, "Just four\nWORDS here")]
    random.Random(1).shuffle(rows)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs_of(spark, rows), percent).collect()}
    want = _groups(rows, percent)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (i == want[i]) and r.n_shingles == len(_sets(rows)[i][0]) for i, r in got.items())


def test_families_under_the_threshold_send_each_text_once_a_cell(spark, monkeypatch):
    """300 texts of one family, most pairs at a similarity around 0.82 and to be verified at 0.85."""
    pick, head = random.Random(82), words(82, 400)
    texts = []
    for _ in range(300):
        own = list(head)
        for at in pick.sample(range(400), 4):
            own[at] = f"x{pick.random()}"
        texts.append(" ".join(own))
    docs = docs_of(spark, list(enumerate(texts)))
    plain, sent = near_dedup._verified, []

    def counted(pairs, *args):
        ends = pairs.select("cell", F.explode(F.array("a", "b"))).distinct()
        sent.append((pairs.count(), ends.count()))
        return plain(pairs, *args)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, percent=85).collect()}
    monkeypatch.setattr(near_dedup, "_verified", plain)
    assert got == near_brute(texts, 85)
    pairs, ends = (sum(x) for x in zip(*sent, strict=True))
    assert pairs > 5_000 and ends < pairs  # with a pair a row, twice as many texts as pairs were sent


def near_brute(texts: list[str], percent: int) -> dict[int, int]:
    sets = [set(zip(*(t.split()[i:] for i in range(5)), strict=False)) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(texts))}


def test_near_dedup_edges(spark, edges, nothing):
    out = near_dedup.near_duplicates(edges).collect()
    assert len(out) == len(EDGES)
    for r in out:
        assert r.component_id == r.doc_id and r.kept
    assert {r.n_shingles for r in out if r.doc_id in (1, 2, 3)} == {0}
    assert near_dedup.near_duplicates(nothing).count() == 0
    # rows that repeat a doc_id with other texts are one document
    a, b = " ".join(words(1, 30)), " ".join(words(2, 30))
    got = near_dedup.near_duplicates(docs_of(spark, [(1, a), (2, a), (2, b), (3, b), (None, a)])).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in got) == [(0, None), (1, 1), (2, 1), (2, 1), (3, 1)]


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(5)
    for share in (0.0, 0.3, 0.6, 0.8, 0.95):
        both = rng.integers(0, 1 << 64, int(2000 * share), np.uint64)
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 64, 2000 - len(both), np.uint64)])) for _ in range(2))
        r = near_dedup.registers([a, b])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        got = near_dedup.estimate(*(np.array([(f(r[0], r[1])).sum()]) for f in (np.greater, np.less, np.equal)),
                                  np.array([float(len(a))]), np.array([float(len(b))]))
        assert abs(got[0] - true) < 0.15


def test_registers_merge_by_maximum():
    rng = np.random.default_rng(6)
    a, b = (np.unique(rng.integers(0, 1 << 64, 500, np.uint64)) for _ in range(2))
    one, two, both = near_dedup.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(one, two) == both).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------- 7: suffix arrays
def _without_repeats(rows, n=suffix_dedup.LENGTH):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - n + 1):
            key = (i is None, i or 0, s)
            if first.setdefault(b[s:s + n], key) < key:
                gone[s:s + n] = b"\1" * n
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def _cut(docs):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(docs).collect()), key=str)


@pytest.mark.parametrize("shard", [8192, 8])
def test_removed_bytes_equal_brute_force(spark, shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_SNIPPETS", shard)  # 8: hot anchors are split and merged
    pick = random.Random(3)
    passages = [" ".join(words(700 + k, 30)) for k in range(4)]
    line = " ".join(words(900, 9))[:60]
    rows = []
    for i in range(60):
        text = " ".join(words(i, 40)) + line + passages[i % 4][pick.randint(0, 30):] + " ".join(words(300 + i, 40)) + line
        rows.append((2 * i, text if i % 7 else text + text))
    rows += [(500, rows[5][1]), (501, "ab" * 400), (502, "ab" * 300), (503, "x" * 99), (504, "x" * 99), (505, "é" * 50), (506, "é" * 50),
             (507, None), (508, ""), (None, rows[2][1]), (509, "y" * 100), (510, "y" * 101)]
    assert _cut(docs_of(spark, rows)) == _without_repeats(rows)


def test_suffix_dedup_edges(spark, edges, nothing):
    assert _cut(edges) == _without_repeats([(i, t) for i, t, _ in EDGES])
    assert suffix_dedup.remove_repeats(nothing).count() == 0
    text = " ".join(words(1, 60))
    twice = [(1, text), (1, text)]  # one document given twice: neither is earlier
    assert _cut(docs_of(spark, twice)) == _without_repeats(twice)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(1, 3 if seed < 3 else 200, 300 + seed).astype(np.int16)
    if seed == 5:
        data = np.tile(np.array([1, 2, 1, 257], np.int16), 80)
    order = suffix_dedup.suffix_array(data)
    suffixes = [tuple(data[i:].tolist()) for i in range(len(data))]
    assert order.tolist() == sorted(range(len(data)), key=suffixes.__getitem__)
    shared = suffix_dedup.common_prefixes(data, order).tolist()
    for k in range(1, len(order)):
        a, b = suffixes[order[k - 1]], suffixes[order[k]]
        assert shared[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# ------------------------------------------------------- 10: quotation links
MAIL = "id long, at long, role string, text string, box long, scope long, hash string"


def _mail(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "h") for r in rows], MAIL)


def test_conversations_from_nested_quotes(spark):
    rows = [
        (10, 1, "ann", "Shall we meet\non Monday at the office?\n\nBring the plans."),
        (11, 2, "bob", "On Friday ann wrote:\n> shall we  MEET on Monday at\n> the office?\nYes, gladly."),
        (12, 3, "ann", "> > Shall we meet on Monday at the office?\n> Yes, gladly.\n\nGood."),
        (13, 4, "cid", ">> Bring the plans.\n> nobody said this\nWhich ones?"),
        (14, 5, "dee", "A new matter."), (15, 6, "eve", "> Yes, gladly.\n> \n> A new matter.\nBoth."),
        (16, 0, "fay", "> A new matter.\nToo early."), (17, 7, None, None), (18, 8, "gus", ""), (None, 9, "x", "lost"), (19, None, "x", "lost"),
        (14, 5, "dee", "A new matter.")]
    got = {r.id: r for r in quote_links.link_quotes(_mail(spark, rows)).collect()}
    assert {i: (r.reply_to, r.conversation, r.depth, r.turn) for i, r in got.items()} == {
        10: (None, 10, 0, 0), 11: (10, 10, 1, 1), 12: (11, 10, 2, 2), 13: (10, 10, 1, 3), 14: (None, 14, 0, 0), 15: (14, 14, 1, 1),
        16: (None, 16, 0, 0), 17: (None, 17, 0, 0), 18: (None, 18, 0, 0)}
    assert got[11].text == "Yes, gladly." and got[12].text == "Good." and got[17].text == ""
    assert got[11].formatted == "<|bob|>\nYes, gladly.\n"


def test_scopes_and_repeated_paragraphs(spark):
    rows = [(i, i, "a", "Thanks!") for i in range(30)] + [(100 + i, 100 + i, "b", "> Thanks!\nWelcome.") for i in range(30)]
    got = {r.id: r for r in quote_links.link_quotes(_mail(spark, rows)).collect()}
    assert {got[100 + i].reply_to for i in range(30)} == {0}  # a repeated paragraph means its first message
    assert sorted(r.turn for r in got.values() if r.conversation == 0) == list(range(31))
    boxes = _mail(spark, [(1, 1, "a", "Hello there."), (2, 2, "b", "> Hello there.\nHi.")]).withColumn("box", quote_links.F.col("id"))
    assert {r.reply_to for r in quote_links.link_quotes(boxes, scope="box").collect()} == {None}


def test_a_long_chain_and_no_messages(spark):
    rows = [(0, 0, "a", "m0")] + [(i, i, "a", f"> m{i - 1}\nm{i}") for i in range(1, 40)]
    got = quote_links.link_quotes(_mail(spark, rows)).collect()
    assert sorted((r.id, r.conversation, r.depth, r.turn) for r in got) == [(i, 0, i, i) for i in range(40)]
    assert quote_links.link_quotes(_mail(spark, [])).count() == 0


def test_parse_quotes():
    assert quote_links.parse_quotes("a\nb\n\n> c\n>> d\n> > e\nf") == [(0, ["a", "b"]), (1, ["c"]), (2, ["d", "e"]), (0, ["f"])]


# ----------------------------------------------------------------- pipeline
def test_every_stage_on_edges_and_nothing(spark, edges, nothing, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, " ".join(words(77, 30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nothing, str(tmp_path))
        assert out.count() == 0
        rows = stage(spark, edges, str(tmp_path))
        if name != "bpe":
            assert rows.columns == edges.columns
        assert rows.count() > 0


def test_pipeline_decisions(spark, tmp_path):
    import corpus_pipeline

    item = " ".join(words(77, 30))
    rows = [(i, " ".join(words(i, 60)), "en") for i in range(30)]
    rows += [(100, rows[3][1] + " more", "en"), (101, rows[3][1], "en"), (102, "1234 5678", None), (103, rows[4][1] + " " + item, "en"),
             (103, rows[4][1] + " " + item, "en")]
    rows = [(i, f"{t}\nsent from my phone today", x) if i < 30 else (i, t, x) for i, t, x in rows]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(range(30))
    assert all(got[i].text == " ".join(words(i, 60)) and got[i].n_tokens == len(got[i].ids) for i in got)
    assert collections.Counter(n for n, _ in corpus_pipeline.STAGES).most_common(1)[0][1] == 1


def test_gibberish_and_unlearned_languages_go(spark, tmp_path):
    import corpus_pipeline

    shifted = str.maketrans("abcdefghijklmnop", "qrstuvwxyzéèüäöß")
    vocabulary = words(5000, 300)
    text = lambda k, n: " ".join(random.Random(k).choices(vocabulary, k=n))
    good = [(i, text(i, 5 + i), "aa") for i in range(80)] + [(100 + i, text(i, 5 + i).translate(shifted), "bb") for i in range(80)]
    good += [(300 + i, text(900 + i, 30), None) for i in range(10)]
    noise = random.Random(1)
    bad = [(500, "qzx 8817 ### kjw vvv 0x3f zzkq pwx 99 qqj", None), (501, "Все люди рождаются свободными и равными в своем достоинстве", None),
           (502, "所有人类生而自由在尊严和权利上一律平等他们赋有理性和良心", None), (503, "所有人类生而自由在尊严和权利上一律平等他们赋有理性和良心", "aa"),
           (504, " ".join("".join(noise.choices("abcdefghijklmnopqrstuvwxyz0123456789#", k=6)) for _ in range(60)), None)]
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs_of(spark, good + bad), str(tmp_path)).collect()}
    assert kept == {i for i, _, _ in good}
