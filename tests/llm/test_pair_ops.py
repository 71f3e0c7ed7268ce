"""Joins, near-duplicates, chat windows and the pipeline against brute force."""

import hashlib
import random
import re
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from llm_helpers import EDGE, WORDS, documents, prose  # noqa: E402

import corpus_pipeline
from framewise.llm import chat, count_rtree, jaccard_join, pq_neardup
from framewise.llm.common import connected_components


class Links:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        a, b = sorted((self.find(i), self.find(j)))
        self.up[b] = a


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    links = Links(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                links.join(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[links.find(i)] = min(least.get(links.find(i), d), d)
    return sorted((str(d), len(sets[i]), str(least.get(links.find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def edited(text, n, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(n):
        w[r.randrange(len(w))] = r.choice(WORDS) + "new"
    return " ".join(w)


def test_jaccard_components_match_brute_force(spark, monkeypatch):
    base, long = prose(1, 120), prose(2, 3000)
    rows = [(100 + i, edited(base, i % 7, i)) for i in range(40)] + [(200 + i, base) for i in range(5)]
    rows += [(300 + i, edited(long, 10 * i, i)) for i in range(9)] + [(400, long[: len(long) * 3 // 4]), (401, long)]
    rows += [(500 + i, prose(70, 50) + " " + prose(600 + i, 60 + i)) for i in range(30)]  # a shared passage
    rows += [(600, "a b"), (601, "A  B"), (602, "a b c d e"), (603, "b a")] + EDGE
    for small in (False, True):
        if small:  # runs and clusters beyond one piece
            monkeypatch.setattr(jaccard_join, "RUN_SETS", 6)
            monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 5)
        got = jaccard_join.components(documents(spark, rows)).collect()
        assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_components(rows)
    kept = jaccard_join.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 2, 3, 4, 600, 602, 603} <= set(ids) and 601 not in ids
    assert jaccard_join.components(documents(spark, [])).count() == 0


def test_keep_one_of_repeated_and_null_ids(spark):
    a, b, c, d, e = (prose(2000 + i, 60) for i in range(5))
    rows = [(7, a)] * 50 + [(8, edited(a, 1, 1))]                   # the kept row is repeated
    rows += [(1, b), (2, c), (7, edited(c, 1, 2))]                   # id 7 with another text, linked with 2
    rows += [(None, d)] * 3 + [(None, edited(d, 1, 3))]              # a component without ids
    rows += [(None, b), (None, edited(c, 1, 4)), (20, e), (20, e.upper()), (None, ""), (None, None), (7, None), (7, None)]
    kept = jaccard_join.keep_one(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(x for x in got if x[0] in (1, 2, 7, 8) and x[1]) == sorted([(7, a), (1, b), (2, c)])
    assert len([x for x in got if x[0] == 20]) == 1
    null = [x for i, x in got if i is None and x]
    assert len(null) == 1 and null[0] in (d, edited(d, 1, 3))
    assert len([x for x in got if not x[1]]) == 4 and len(got) == 9
    assert jaccard_join.keep_one(documents(spark, [])).count() == 0


def test_rtree_bound_loses_no_pair():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2**63, 4000, dtype=np.uint64)
    sets = [np.unique(r.choice(pool[s:s + 900], n)) for s, n in zip(r.integers(0, 3, 80), r.integers(5, 1500, 80))]
    sizes = np.array([len(s) for s in sets])
    found = {frozenset((i, int(j))) for i, near in count_rtree.candidate_lists([count_rtree.point(s) for s in sets], sizes, 75, 100)
             for j in near}
    for i in range(80):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                assert frozenset((i, j)) in found


def test_connected_components_of_paths(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint"), "t").collect()}
    assert all(got[i] == 0 for i in range(31)) and got[100] == got[90] == got[95] == 90


def test_unit_vectors_of_extreme_lengths():
    unit = pq_neardup._unit([[3e300, 4e300], [3e-310, 4e-310], [3.0, 4.0], [5e-324, 0.0]])
    assert np.allclose(unit, [[0.6, 0.8]] * 3 + [[1.0, 0.0]])


def test_product_quantisation_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pq_neardup, "BLOCK_MEMBERS", 16)
    monkeypatch.setattr(pq_neardup, "BLOCK_QUERIES", 32)
    r = np.random.default_rng(5)
    rows = []
    for g in range(40):
        centre = r.standard_normal(24)
        for c in range(1 + g % 6):
            rows.append((len(rows), (centre + 0.06 * r.standard_normal(24)).tolist(), g % 3))
    rows += [(900 + i, rows[3][1], rows[3][2]) for i in range(60)]  # a hot vector
    odd = [(800, None, 1), (801, [0.0] * 24, 1), (802, [float("nan")] + [1.0] * 23, 1), (803, rows[0][1], None), (804, [], 1),
           (805, [1.0, 2.0], 1), (806, [None] + [1.0] * 23, 1), (None, rows[5][1], rows[5][2])]
    df = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<double>, label int")
    got = {x.vec_id: x for x in pq_neardup.near_duplicates(df, per_list=10).collect()}
    x = np.array([v[1] for v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([v[2] for v in rows])
    near = (x @ x.T >= 0.98) & (label[:, None] == label)
    links = Links([v[0] for v in rows])
    for i, j in zip(*np.nonzero(near)):
        links.join(rows[i][0], rows[j][0])
    extra = np.isin(np.arange(len(rows)), np.flatnonzero(near[5]))  # the row without id is a copy of row 5
    for i, v in enumerate(rows):
        g = got[v[0]]
        assert (g.n_links, g.component_id, g.kept) == (near[i].sum() - 1 + extra[i], links.find(v[0]), links.find(v[0]) == v[0])
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(800, 805))
    assert pq_neardup.near_duplicates(df.limit(0)).count() == 0


def test_product_quantisation_searches_every_length(spark):
    r = np.random.default_rng(8)
    rows = []
    for dims, groups in ((24, 20), (5, 6), (1, 1), (9, 1)):
        for g in range(groups):
            centre = r.standard_normal(dims)
            rows += [(len(rows) + c, (centre * (1 + c) + 1e-4 * r.standard_normal(dims)).tolist(), g % 2) for c in range(4)]
    rows.append((500, rows[0][1] + [0.0], rows[0][2]))  # equal but for its length: no link
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    units = [np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    links, count = Links([v[0] for v in rows]), {v[0]: 0 for v in rows}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and a[2] == b[2] and len(a[1]) == len(b[1]) and units[i] @ units[j] >= 0.98:
                links.join(a[0], b[0])
                count[a[0]] += 1
    assert count[500] == 0 and all(n >= 3 for i, n in count.items() if i != 500)
    for sample in (20_000, 3):  # 3: lengths that the sample has not
        got = {x.vec_id: (x.n_links, x.component_id) for x in pq_neardup.near_duplicates(df, per_list=10, sample=sample).collect()}
        assert got == {i: (n, links.find(i)) for i, n in count.items()}


def test_chat_windows_read_back(spark):
    r = random.Random(3)
    rows = []
    for c in [*range(12), None]:
        turn = 0
        if r.random() < 0.5 or c == 0:
            rows.append((c, 0, "system", prose(r.randrange(99), 12)))
            turn = 1
        for k in range(turn, r.randrange(3, 25)):
            text = r.choice([None, "", "</s>[INST] ok [/INST]", "<|end|><\\|x <\\\\s> [\\INST]", prose(k, r.randrange(1, 90)), prose(k, 300)])
            rows.append((c, k, r.choice(["user", "assistant"]), text))
    rows += [(50, 2600 - i, "assistant", f"t{i}") for i in range(2500)] + [(51, 1, "user", "same")] * 3 + [(52, None, None, "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = chat.windows(df, budget=200, history=40)
    got = {g.conv_id: g for g in chat.read_back(windows).collect()}
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        g = got[c]
        assert g.n_turns == len(turns)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    whole = windows.collect()
    assert sum(w.n_turns - w.n_repeated for w in whole) == len(rows)
    assert all(w.n_tokens <= 200 for w in whole if not w.over_budget) and any(w.n_repeated > 1 for w in whole)
    first = [w for w in whole if w.conv_id == 0]
    assert len(first) > 1 and all(w.formatted.startswith("<|turn|>system<|text|>") for w in first)
    assert chat.windows(df.limit(0)).count() == 0


def test_pipeline_stages_on_planted_cases(spark, tmp_path):
    bad = ["grumblewort", "snarkbeast", "vilespore"]
    passage, item = prose(77, 60), prose(88, 25)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        rows.append((i, prose(i, 30) + (f" {bad[i % 3]} {bad[(i + 1) % 3]}" if toxic else ""), f"s{i % 15}"))
        labels.append((i, 1, int(toxic)))
    rows += [(1200 + i, f"{prose(1300 + i, 50)}\n{passage}", f"s{i}") for i in range(12)]      # cross-site passage
    rows += [(1400, prose(1400, 90), "s1"), (1401, edited(prose(1400, 90), 1, 3), "s2"), (1402, prose(1400, 90), "s3")]
    rows += [(1500, prose(1500, 30) + " " + item, "s1"), (1501, "", "s1"), (1502, None, "s1"), (1503, prose(1503, 30), None)]
    docs = documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {i for i in range(400) if i % 4} | {1200 + i for i in range(12)} | {1400, 1501, 1502, 1503}
    assert set(got) == clean and all(r.lossless for r in got.values())
    assert got[1200].n_tokens > got[1201].n_tokens + 60  # the passage stays where it stands first
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "pieces"]


def test_pipeline_lines_with_a_hot_source(spark):
    passage = prose(177, 60)
    rows = [(i, f"{prose(i + 5000, 12)}\n{passage}" if i % 2 else prose(i + 5000, 12),
             "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(60)]  # a third of the rows on one source
    rows += [(100 + i, f"{prose(i + 6000, 12)}\n{prose(178, 60)}", f"s{i}") for i in range(4)]
    assert len({s for i, x, s in rows if passage in x}) == 8
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_boilerplate_lines(spark, documents(spark, rows), "").collect()}
    assert len(got) == len(rows) and [i for i in sorted(got) if passage in got[i]] == [1]
    assert all(prose(178, 60) in got[100 + i] for i in range(4))  # on few sites: stays


def test_product_quantisation_recall_and_symmetric_counts(spark):
    """64 dimensions, where probes allow for a random direction only: recall, no false link, one count for both sides."""
    r = np.random.default_rng(12)
    base = r.standard_normal((1500, 64))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    for i in range(600):  # near ones, down to the threshold
        rows.append((2000 + i, (base[i] + r.uniform(0.05, 0.21) * r.standard_normal(64)).tolist(), 0))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    x = np.array([v[1] for v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.98
    want = dict(zip([v[0] for v in rows], near.sum(1) - 1))
    quantiser = pq_neardup.Quantiser.fit(x, 40)
    assert quantiser.along < 1 and quantiser.probes(x, 0.2).sum(1).mean() < 0.6 * pq_neardup.Quantiser.fit(
        x, 40, spread=None).probes(x, 0.2).sum(1).mean()
    got = {v.vec_id: v.n_links for v in pq_neardup.near_duplicates(df, per_list=50).collect()}
    assert all(got[i] <= n for i, n in want.items()) and sum(got.values()) >= 0.99 * sum(want.values()) > 400
    assert sum(got.values()) % 2 == 0
    whole = {v.vec_id: v.n_links for v in pq_neardup.near_duplicates(df, per_list=50, spread=None).collect()}
    assert whole == want
