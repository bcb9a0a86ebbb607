"""Embedding operators against brute force, URL filter cases, the pipeline's stages."""

import math
from collections import Counter

import numpy as np
import duckdb
import pytest

import corpus_pipeline
from lendspark.llm import ann, embeddup, urlfilter
from lendspark.llm import queries as corpus

NAN, INF = float("nan"), float("inf")
ODD = [(900, None, 1), (901, [0.0] * 4, 1), (902, [NAN, 1.0, 0.0, 0.0], 1), (903, [INF, 1.0, 0.0, 0.0], 1), (904, [None, 1.0, 0.0, 0.0], 1),
       (905, [1.0, 0.0], 1), (906, [1e-30, 0.0, 0.0, 0.0], 1), (907, [1e30, 1e24, 0.0, 0.0], 1), (908, [], 1), (909, [1.0, 0.0, 0.0, 0.0], None)]


def cloud(n, dim=4, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(max(2, n // 6), dim))
    x = base[rng.integers(0, len(base), n)] + rng.normal(size=(n, dim)) * rng.choice([0.0, 0.02, 0.2], size=(n, 1))
    return [(k, [float(v) for v in np.float32(row)], int(label)) for k, (row, label) in enumerate(zip(x, rng.integers(0, 3, n)))]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, label int, id long, cell int, vec string")


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute_links(rows):
    links = [set() for _ in rows]
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            if i != j and la is not None and la == lb and good(a) and good(b) and len(a) == len(b):
                x, y = np.float64(np.float32(a)), np.float64(np.float32(b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i].add(j)
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in links[i]:
            a, b = group[i], group[j]
            group = [min(a, b) if g in (a, b) else g for g in group]
    return links, group


@pytest.mark.parametrize("block", [1024, 8])
def test_embedding_dedup_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddup, "BLOCK", block)
    monkeypatch.setattr(embeddup, "PER_CELL", 10)
    rows = cloud(240) + ODD + [(910 + k, [0.5, 0.5, 0.0, 0.0], 2) for k in range(40)]
    links, group = brute_links(rows)
    got = {r.vec_id: r for r in embeddup.near_vectors(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    low = {}
    for g, (i, _, _) in zip(group, rows):
        low[g] = min(low.get(g, i), i)
    for (i, _, _), linked, g in zip(rows, links, group):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(linked), low[g], low[g] == i)


def test_embedding_dedup_odd_tables(spark):
    assert embeddup.near_vectors(frame(spark, [])).count() == 0
    assert [tuple(r) for r in embeddup.near_vectors(frame(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]
    twice = embeddup.near_vectors(frame(spark, [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [-1.0, 0.0], 1)])).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in twice) == Counter({(1, 2, 1): 2, (None, 2, 1): 1, (2, 0, 2): 1})


def test_search_recall_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, [float(v) for v in row], 0) for k, row in enumerate(np.float32(rng.normal(size=(1500, 16))))]
    rows += [(5000 + k, rows[3][1], 0) for k in range(30)]  # ties
    monkeypatch.setattr(ann, "BEAM", 120)
    odd = [(i, v, n) for i, v, n in ODD if i not in (907,)]
    df = frame(spark, rows + odd + [(None, rows[0][1], 0)])
    found = ann.search(df, df.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding AS query"), k=20).collect()
    ids = np.array([i for i, _, _ in rows])
    x = np.array([v for _, v, _ in rows], dtype=np.float64)
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r)
    hits = []
    for q in [i for i in ids if i % 20 == 0]:
        s = x @ x[list(ids).index(q)]
        order = [k for k in np.lexsort((ids, -s)) if ids[k] != q][:20]
        hits.append(len({r.vec_id for r in by[q]} & set(ids[order])) / 20)
        assert [r["rank"] for r in by[q]] == list(range(1, 21))
        assert np.allclose([r.score for r in by[q]], [s[list(ids).index(r.vec_id)] for r in by[q]], rtol=1e-12)
        assert [(-r.score, r.vec_id) for r in by[q]] == sorted((-r.score, r.vec_id) for r in by[q])
    assert np.mean(hits) >= 0.9
    assert set(by) == {i for i in ids if i % 20 == 0}


def recall(spark, rows, step):
    """Share of the nearest ids found, by id, against brute force."""
    df = frame(spark, rows)
    by = {}
    for r in ann.search(df, df.where(f"vec_id % {step} = 0").selectExpr("vec_id AS query_id", "embedding AS query"), k=20).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    ids, x = np.array([i for i, _, _ in rows]), np.array([v for _, v, _ in rows], dtype=np.float32).astype(np.float64)
    hits = []
    for q in np.flatnonzero(ids % step == 0):
        order = [k for k in np.lexsort((ids, -np.round(x @ x[q], 12))) if k != q][:20]
        hits.append(len(by.get(int(ids[q]), set()) & set(ids[order].tolist())) / 20)
    return float(np.mean(hits))


def test_search_finds_tight_groups_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for size in [30] * 30 + [60] * 15 + [700]:
        base = rng.normal(size=24)
        x = base / np.linalg.norm(base) + rng.normal(size=(size, 24)) * 1e-3
        rows += [[float(v) for v in np.float32(row / np.linalg.norm(row))] for row in x]
    for size in (40, 600):
        base = rng.normal(size=24)
        rows += [[float(v) for v in np.float32(base / np.linalg.norm(base))]] * size
    rows = [(int(i), v, 0) for i, v in zip(rng.permutation(len(rows)), rows)]
    monkeypatch.setattr(ann, "TOP", 40)  # leads of leads
    monkeypatch.setattr(ann, "CELLS", 4)  # cells below cells
    monkeypatch.setattr(ann, "BLOCK", 128)
    assert recall(spark, rows, 15) >= 0.95


def test_search_answers_within_each_length(spark):
    rows = [(k, [1.0, float(k)], 0) for k in range(30)] + [(100 + k, [1.0, 0.5, float(k)], 0) for k in range(4)]
    df = frame(spark, rows)
    got = ann.search(df, df.where("vec_id in (0, 100)").selectExpr("vec_id AS query_id", "embedding AS query"), k=3).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (100, 1, 101), (100, 2, 102), (100, 3, 103)]


def test_search_small_tables(spark):
    few = frame(spark, [(0, [1.0, 2.0], 0), (1, [2.0, 2.0], 0), (20, [0.5, 0.1], 0)])
    asked = few.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding AS query")
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in ann.search(few, asked).collect()) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert ann.search(few.where("false"), asked).count() == 0
    assert ann.search(few, asked.where("false")).count() == 0


def judged(spark, urls, labels=()):
    pages = spark.createDataFrame([(k, u, "<html>", "h", 1) for k, u in enumerate(urls)], "page_id long, url string, html string, host string, good int")
    known = spark.createDataFrame(list(labels), "doc_id long, good int")
    return {r.page_id: r for r in urlfilter.judge(pages, known, corpus.URL_RULES).collect()}


def test_url_parsing_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?q=http://b.org/", "https://www.example.com/en/a", "https://x.www.example.com/en/a",
            "https://example.com#f", "http://notcom/es/", "http://net/es/1", "http://a.b.net/fr/2#x", "http://net/de/", "ftp://ÄB.net?x/es/", "http://a.net/ES/1"]
    got = judged(spark, urls)
    seen = {u: (got[k].host, got[k].path, got[k].rule, got[k].verdict) for k, u in enumerate(urls)}
    assert seen[None] == seen[""] == seen["no scheme"] == seen["http://"] == ("", "", None, "allow")
    assert seen[urls[4]] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert seen[urls[5]] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert seen[urls[6]][2:] == ("www.example.com/en/", "allow")
    assert seen[urls[7]] == ("example.com", "", None, "allow")
    assert seen[urls[8]] == ("notcom", "/es/", None, "allow")
    assert seen[urls[9]][2:] == ("net/es/", "block") and seen[urls[10]][2:] == ("net/fr/", "block")
    assert seen[urls[11]][2:] == (None, "allow") and seen[urls[12]][:2] == ("Äb.net", "") and seen[urls[13]][2] is None
    assert judged(spark, []) == {}


def test_url_templates_reject_by_purity(spark):
    urls = [f"http://a.org/spam/{k}" for k in range(60)] + [f"http://a.org/good/{k}" for k in range(100, 160)] + [f"http://a.org/rare{k}/{k}" for k in range(200, 206)]
    labels = [(k, 0) for k in range(0, 60, 2)] + [(k, 1) for k in range(100, 160, 2)] + [(None, 1), (100, 1)]
    got = judged(spark, urls, labels)
    assert {got[k].template for k in range(60)} == {"/spam/*"} and {got[k].verdict for k in range(60)} == {"block"}
    assert {got[k].template for k in range(60, 120)} == {"/good/*"} and {got[k].verdict for k in range(60, 126)} == {"allow"}
    assert {got[k].template for k in range(120, 126)} == {"/*/*"}
    alike = judged(spark, urls, [(k, 1) for k in range(0, 60, 2)] + [(k, 1) for k in range(100, 160, 2)])
    assert {r.template for r in alike.values()} == {"/*/*"}  # statistically similar branches are one


def test_small_and_deep_url_sections_are_told_apart(spark):
    urls = [f"http://a.org/s{k % 60}/{k}" for k in range(3000)]  # 60 sections of less than 2 %
    urls += [f"http://b.org/x/y/z/{'bad' if k % 30 == 0 else 'fine'}/{k}" for k in range(3000, 6000)]
    urls += [f"http://c.org/x/y/z/v/{k}/{'bad' if k % 2 else 'fine'}/{k}" for k in range(6000, 6100)]
    bad = [k < 3000 and k % 60 == 7 or 3000 <= k < 6000 and k % 30 == 0 or k >= 6000 and k % 2 for k in range(6100)]
    got = judged(spark, urls, [(k, int(not b)) for k, b in enumerate(bad)])
    assert len(got) == 6100 and [got[k].verdict for k in range(6100)] == ["block" if b else "allow" for b in bad]
    assert got[7].template == "/s7/*" and got[8].template == "/*/*"
    assert got[3000].template == "/*/*/*/bad" and got[6001].template == "/*/*/*/*/*/bad"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.execute("INSERT INTO pages SELECT unnest(?), unnest(?)", [list(range(6100)), urls])
    con.execute("INSERT INTO labels SELECT unnest(?), unnest(?), 0", [list(range(6100)), [int(not b) for b in bad]])
    rows = con.execute(f"SELECT page_id, template, purity, verdict FROM ({urlfilter.judge_sql(corpus.URL_RULES)})").fetchall()
    assert {(p, t, v) for p, t, _, v in rows} == {(k, r.template, r.verdict) for k, r in got.items()}
    assert all(abs(got[p].purity - purity) < 1e-8 for p, _, purity, _ in rows)
    plain = judged(spark, urls[3000:], [(k, 1) for k in range(6100)])
    assert {r.template for r in plain.values()} == {"/*/*/*"}


def test_url_filter_is_native(spark, sf):
    plan = corpus.QUERIES["op6_url_filter"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "html" not in plan.split("== Physical Plan ==")[1]


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (70001, "", "en", "s", 0), (70002, "123 !!!", "en", None, 7), (70003, "123 !!!", "en", None, 7)], docs.schema)
    step = docs.union(odd)
    names, sizes = [], [step.count()]
    for name, stage in corpus_pipeline.STAGES:
        step = corpus_pipeline.save(stage(spark, step, sf))
        names.append(name)
        sizes.append(step.count())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert step.columns == docs.columns and step.dtypes == docs.dtypes
    assert len(names) == 5 and sizes[1] == sizes[0] - 4  # odd documents are rejected, all others stay
    assert sizes[3] <= sizes[2] < sizes[1] < sizes[0]
    assert step.where("not round_trip").count() == 0 and step.count() == sizes[4]


def test_pipeline_on_empty_table(spark, sf):
    step = spark.read.parquet(f"{sf}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, sf)
    assert step.count() == 0


def test_descents_go_on_and_cells_follow_the_rows(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.float32(rng.normal(size=(3000, 12)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    vectors = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "id long, vec array<double>").persist()
    monkeypatch.setattr(ann, "CELLS", 2)
    monkeypatch.setattr(ann, "BLOCK", 64)
    centres = ann.fit(vectors, 2)
    assert sum(map(len, ann._fine(vectors, centres, 3000))) > 40  # about 3000 / 32
    near = {r.v: {e.u for e in r.near} for r in ann.build(vectors, centres, 3000).collect()}
    s = np.float64(x) @ np.float64(x).T
    np.fill_diagonal(s, -1)
    assert np.mean([len(near[v] & set(np.argsort(-s[v])[:ann.K].tolist())) / ann.K for v in range(3000)]) >= 0.9
