"""Vector operators, url lists, components and the pipeline."""

import datetime as dt
import math

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import data
from vireo.llm import ann_blocks, collision, graph, near_dup, packing, queries, url_lists

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    return data.frame(spark, [(i, v, 0, "x", "x", "x", "x") for i, v in rows], data.VECTORS)


def edge_vectors():
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(50)] + [(400, rows[20][1]), (400, rows[20][1]), (401, [float(np.float32(x * 3)) for x in rows[20][1]])]
    rows += [(500, None), (520, [0.0] * 6), (540, [NAN] * 6), (560, [INF, *[1.0] * 5]), (580, [None, *[1.0] * 5]), (600, []), (None, [1.0] * 6), (620, [1.0, 2.0]), (640, [2.0, 4.0])]
    return rows


def valid(rows):
    out = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = np.array(v, dtype=np.float64)
            out[i] = min(out[i], v, key=tuple) if i in out else v
    return out


def brute_nearest(rows, k):
    known = valid(rows)
    out = set()
    for q, x in known.items():
        if q % 20 == 0:
            best = sorted((-(x * y).sum(), i) for i, y in known.items() if i != q and len(y) == len(x))[:k]
            out |= {(q, r, i, round(-s, 9)) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("base,asked", [(8192, 8192), (37, 5)])
def test_nearest_equals_brute_force(spark, base, asked):
    rows = edge_vectors()
    for k in (20, 3):
        got = {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in ann_blocks.nearest(vectors(spark, rows), k=k, base_rows=base, query_rows=asked).collect()}
        assert got == brute_nearest(rows, k)


def test_nearest_of_nothing(spark):
    assert ann_blocks.nearest(vectors(spark, [])).count() == 0
    assert ann_blocks.nearest(vectors(spark, [(20, [1.0]), (40, None)])).count() == 0


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(0)
    x, y = rng.standard_normal((50, 33)) * 10, rng.standard_normal((60, 33))
    cx, sx, nx, ex = ann_blocks.quantise(x)
    cy, sy, _, ey = ann_blocks.quantise(y)
    near = (cx.astype(float) @ cy.T) * sx[:, None] * sy[None, :]
    slack = np.outer(nx, ey) + np.outer(ex, np.linalg.norm(y, axis=1))
    assert (np.abs(x @ y.T - near) <= slack).all()


def test_nearest_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in queries.op1_block_matrix_ann(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute_nearest(rows, 20)


# ------------------------------------------------------------------ near-duplicate vectors

def brute_links(rows, least=0.95):
    known = valid(rows)
    ids = sorted(known)
    links = {i: set() for i in ids}
    for d in {len(v) for v in known.values()}:
        same = [i for i in ids if len(known[i]) == d]
        x = np.array([known[i] for i in same])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(x @ x.T >= least)
        for i, j in zip(a, b):
            if i != j:
                links[same[i]].add(same[j])
    component = {i: i for i in ids}
    for i in ids:
        if component[i] == i:
            todo = [i]
            while todo:
                for j in links[todo.pop()]:
                    if component[j] > i:
                        component[j] = i
                        todo.append(j)
    return {i: (len(links[i]), component[i]) for i in ids}


def test_vector_classes_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = edge_vectors()
    centre = rng.standard_normal(64)
    rows += [(1000 + i, (rng.standard_normal(64)).tolist()) for i in range(400)]
    rows += [(2000 + i, (centre + rng.standard_normal(64) * 0.1).tolist()) for i in range(60)]
    rows = [(i, v if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in collision.vector_classes(vectors(spark, rows)).collect()}
    want = brute_links(rows)
    assert set(got) == {i for i, _ in rows}
    assert got[500] == (0, 500, True) and got[None] == (0, None, True)
    assert got[620][0] == got[640][0] == 1
    missed = sum(max(0, want[i][0] - got[i][0]) for i in want)
    assert missed <= 0.02 * sum(n for n, _ in want.values()) and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] != want[i][1] for i in want) <= 3


def test_dense_cells_are_blocked(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, (np.ones(16) + 0.01 * rng.standard_normal(16)).tolist()) for i in range(150)]
    monkeypatch.setattr(collision, "BLOCK_ROWS", 20)
    got = collision.vector_classes(vectors(spark, rows)).collect()
    assert {r["n_links"] for r in got} == {149} and {r["component_id"] for r in got} == {0}


def test_recall_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute_links(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in queries.op9_collision_near_dup(spark, "/root/testdata/sf0.1").collect()}
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)


def test_calibration_reaches_its_recall():
    for n in (0, 10, 1000, 10**6, 10**9):
        signs, orders = collision.calibrate(n)
        p = (1 - math.acos(0.95) / math.pi) ** signs * math.erf(collision.WINDOW / math.sqrt(0.1) / math.sqrt(2))
        assert 1 - (1 - p) ** orders - orders * p * (1 - p) ** (orders - 1) >= collision.RECALL


def test_vectors_of_nothing(spark):
    assert collision.vector_classes(vectors(spark, [])).count() == 0
    assert [r["n_links"] for r in collision.vector_classes(vectors(spark, [(1, None)])).collect()] == [0]


# ------------------------------------------------------------------ components

@pytest.mark.parametrize("task_links", [1_000_000, 20])
def test_components_of_paths_and_stars(spark, monkeypatch, task_links):
    monkeypatch.setattr(graph, "TASK_LINKS", task_links)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 260)] + [(300, 301), (301, 300), (400, 400)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 200 for i in range(200, 260)}, 300: 300, 301: 300}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ url lists

def at(day):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day)


def test_temporal_lists(spark):
    entries = spark.createDataFrame([
        ("l", "host", "a.example.org", "block", at(10)), ("l", "host", "a.example.org", "remove", at(20)), ("l", "host", "a.example.org", "block", at(400)),
        ("l", "domain", "example.org", "block", at(0)), ("m", "prefix", "a.example.org/en/", "allow", at(12)), ("l", "host", "a.example.org", "allow", at(10)),
        ("l", None, "a.example.org", "block", at(0)), ("l", "host", None, "block", at(0)), ("l", "host", "b.net", "block", None)],
        "list_name string, scope string, pattern string, action string, changed_at timestamp")
    captures = spark.createDataFrame([
        (1, "https://user@A.example.org.:8080/x", at(5), "v"), (2, "http://a.example.org/de/", at(15), "v"), (3, "http://a.example.org/en/x", at(15), "v"), (4, "http://a.example.org/en/x", at(11), "v"),
        (5, "http://a.example.org", at(20), "v"), (6, "http://a.example.org", at(500), "v"), (7, "http://notexample.org/", at(15), "v"), (8, None, at(15), "v"), (9, "mailto:x@example.org", at(15), "v"),
        (10, "http://a.example.org/x", None, "v"), (6, "http://a.example.org", at(500), "v"), (11, "http://b.net/", at(1), "v"), (12, "http://example.org" + "/x" * 20000, at(3), "v")],
        "page_id int, url string, fetched_at timestamp, verdict string")
    got = sorted((r["page_id"], r["verdict"], r["scope"]) for r in url_lists.filtered(captures, entries).collect())
    assert got == sorted([(1, "block", "domain"), (2, "block", "host"), (3, "allow", "prefix"), (4, "block", "host"), (5, "block", "domain"), (6, "block", "host"), (6, "block", "host"),
                          (7, "none", None), (8, "none", None), (9, "none", None), (10, "none", None), (11, "none", None), (12, "block", "domain")], key=lambda x: (x[0], x[1], str(x[2])))
    assert url_lists.filtered(captures.limit(0), entries).count() == 0
    assert {r["verdict"] for r in url_lists.filtered(captures, entries.limit(0)).collect()} == {"none"}


def test_temporal_lists_keep_the_captures_columns(spark):
    entries = spark.createDataFrame([("l", "host", "a.org", "block", at(0))], "list_name string, scope string, pattern string, action string, changed_at timestamp")
    captures = spark.createDataFrame([("http://a.org/", at(1), "own", "kept", "dotted")], "`u.r` string, fetched_at timestamp, scope string, capture_scope string, `a.b` string")
    out = url_lists.filtered(captures, entries, url_col="u.r")
    assert out.columns == ["u.r", "fetched_at", "capture_capture_scope", "capture_scope", "a.b", "verdict", "list_name", "scope", "pattern", "valid_from", "valid_to"]
    r = out.first()
    assert (r["capture_capture_scope"], r["capture_scope"], r["a.b"], r["verdict"], r["scope"]) == ("own", "kept", "dotted", "block", "host")


def test_temporal_lists_equal_sql(spark, duck):
    sf = "/root/testdata/sf0.001"
    df = queries.op3_temporal_url_lists(spark, sf)
    rel = duck(sf).sql(queries.ORACLE["op3_temporal_url_lists"])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    want = sorted((tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == want


def test_temporal_lists_run_without_python(spark):
    plan = url_lists.filtered(queries.page_captures(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")), queries.dated_entries(spark.read.parquet("/root/testdata/sf0.001/pages.parquet")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text and "html" not in text


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, names = docs.columns, []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "secrets", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        names.append(name)
        if name != "packing":
            assert docs.columns == columns
        if name == "near_duplicates":
            from tests.llm.test_text_operators import brute_components

            component = brute_components([(r["doc_id"], r["text"]) for r in before.collect()])
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted(i for i, c in component.items() if i == c)
        if name == "secrets":
            assert docs.count() == before.count() and docs.where("text RLIKE 'AKIA[A-Z0-9]{12}' OR text RLIKE '[0-9a-f]{32}'").count() == 0
    assert docs.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_pipeline_runs_over_edges(spark):
    rows = [r for r in data.edge_rows()]
    docs = data.frame(spark, rows).drop("id", "size", "row", "chunk", "digest", "score", "part", "y", "component_id")
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, "").checkpoint()
    assert docs.count() > 0
    empty = data.frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "/root/testdata/sf0.001").checkpoint()
    assert empty.count() == 0
