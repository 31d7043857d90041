import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice import pipeline, schema
from sluice.functions import nearest
from sluice.operators import bronze, enrich, evaluate, gold, ledger, quality, silver, vectors
from sluice.plans import catalogue
from sluice.sources import landing

def as_of():
    return F.expr("TIMESTAMP '2026-10-01 00:00:00'")


LONG = "<p>We build things.</p>" + "<p>Requirements: Python, SQL and Kafka.</p>" * 5
LANDED = {
    "remotive": [{"id": 1, "title": "Data Engineer", "company_name": "Acme", "candidate_required_location": "Worldwide", "job_type": "full_time", "salary": "$90k - $105k", "publication_date": "2026-09-20T00:00:00", "url": "u1", "description": LONG}, {"id": 1, "title": "Senior Data Engineer", "company_name": "Acme", "candidate_required_location": "Germany", "job_type": "full_time", "salary": "", "publication_date": "2026-09-21T00:00:00", "url": "u1", "description": LONG}],
    "arbeitnow": [{"slug": "x", "title": "Senior Data Engineer (m/w/d)", "company_name": "Acme Inc", "location": "Berlin", "remote": False, "job_types": ["Working student"], "created_at": 1790000000, "url": "u2", "description": LONG}, {"slug": "bad", "company_name": "No Title"}],
    "remoteok": [{"legal": "notice"}, {"id": "7", "position": "Nurse", "company": "Care", "location": "", "salary_min": 30, "salary_max": 36, "tags": ["contract"], "date": "2026-09-30T10:00:00+00:00", "url": "u3", "description": "&lt;p&gt;Care&lt;/p&gt;"}],
    "adzuna_in": [{"id": "9", "title": "Python <strong>Developer</strong> &amp; Lead", "description": "work from home " + "x" * 100, "company": {"display_name": "Beta"}, "location": {"display_name": "Pune"}, "salary_min": 880000, "salary_max": 880000, "salary_is_predicted": "0", "created": "2026-09-29T00:00:00Z", "contract_time": "full_time", "redirect_url": "u4"}],
}


@pytest.fixture()
def landed(tmp_path):
    paths = {}
    for name, rows in LANDED.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
        paths[name] = str(tmp_path / f"{name}.json")
    return paths


def test_run(spark, tmp_path, landed):
    root = str(tmp_path / "data")
    stats = pipeline.run(spark, root, landed, as_of=as_of())
    assert stats["ingest"] == {"new": 5, "changed": 0, "unchanged": 0} and stats["quarantined"] == 1 and stats["duplicates"] == 1
    again = pipeline.run(spark, root, landed, as_of=as_of())
    assert again["ingest"] == {"new": 0, "changed": 0, "unchanged": 5} and again["vectors"] == {"added": 0, "removed": 0}
    rows = {r.source: r for r in pipeline.Store(spark, root).read("silver", schema.SILVER).collect()}
    assert rows["remotive"].title == "Senior Data Engineer" and not rows["remotive"].is_duplicate and rows["arbeitnow"].is_duplicate
    assert rows["arbeitnow"].employment_type == "part_time" and rows["remotive"].country == "DE"
    assert rows["remoteok"].salary_min is None and not rows["remoteok"].is_tech and rows["remoteok"].location == "Remote"
    assert rows["adzuna_in"].salary_max is None and float(rows["adzuna_in"].salary_usd_year_min) == 10000 and rows["adzuna_in"].is_remote
    assert rows["adzuna_in"].title == "Python <strong>Developer</strong> & Lead"
    for name in gold.TABLES:
        assert gold.published(spark, f"{root}/gold", name).count() > 0
    assert pipeline.search(spark, root, "python sql kafka", 1).first().title == "Senior Data Engineer"
    found = pipeline.match(spark, root, spark.createDataFrame([("Python\nKafka engineer",)], "text string")).collect()
    assert found[0].matched == ["Kafka", "Python"] and found[0].missing == ["SQL"] and found[0].coverage == 0.4
    runs = ledger.recent_runs(pipeline.Store(spark, root).read("runs", schema.RUNS)).collect()
    assert [(r.run_id, r.status) for r in runs] == [(2, "success"), (1, "success")]


def test_gate_blocks(spark, tmp_path, landed):
    root = str(tmp_path / "data")
    pipeline.run(spark, root, landed, as_of=as_of())
    with pytest.raises(RuntimeError, match="source_fresh"):
        pipeline.run(spark, root, landed, as_of=F.expr("TIMESTAMP '2027-01-01'"))
    runs = pipeline.Store(spark, root).read("runs", schema.RUNS)
    assert ledger.last_run(runs).first().status == "failed"
    assert spark.read.parquet(f"{root}/gold/current").count() == 1
    checks = ledger.latest_checks(pipeline.Store(spark, root).read("dq", schema.DQ)).collect()
    assert len(checks) == 9 and not checks[0].passed


def test_changes(spark):
    row = "source string, source_job_id string, payload string, ordinal long"
    first = spark.createDataFrame([("s", "1", '{"a": 1, "b": 2}', 0), ("s", "2", "{}", 0), ("s", "3", "no json", 0)], row)
    one = bronze.upsert_raw(spark.createDataFrame([], schema.BRONZE), first, 1, F.expr("TIMESTAMP '2026-01-01'"))
    second = spark.createDataFrame([("s", "1", '{"b":2,"a":1}', 0), ("s", "2", '{"x": 1}', 1), ("s", "2", "{}", 0), ("s", "4", "{}", 0)], row)
    two = bronze.upsert_raw(one, second, 2, F.expr("TIMESTAMP '2026-01-02'"))
    got = {r.source_job_id: r for r in two.collect()}
    assert {k: r.status for k, r in got.items()} == {"1": "unchanged", "2": "changed", "3": "absent", "4": "new"}
    assert got["1"].first_run_id == 1 and got["1"].payload == '{"a": 1, "b": 2}' and got["2"].payload == '{"x": 1}'
    assert got["1"].first_seen_at != got["1"].last_seen_at and got["3"].first_seen_at == got["3"].last_seen_at


def test_sources_fail_alone(spark, landed):
    readers = dict(landing.READERS) | {"remotive": lambda s, p: 1 / 0}
    rows, status = landing.read_sources(spark, landed | {"adzuna_in": None}, readers)
    assert status == {"remotive": "failed: ZeroDivisionError", "arbeitnow": "ok", "remoteok": "ok", "adzuna_in": "skipped"}
    assert rows.count() == 3


def test_enrichment(spark):
    queue = spark.createDataFrame([(1, "h1", "T", "C", "L", "d", None), (2, "h2", "T", "C", "L", "d", None)], "job_id long, content_hash string, title string, company string, location string, description string, posted_at timestamp")
    reply = json.dumps({"jobs": [{"id": 1, "role_family": "qa", "seniority": "boss", "years_experience_min": 3.7, "remote_policy": None, "skills": ["python", 5, "x"]}, {"id": "x"}, {"id": 9}]})
    found, stats = enrich.extract(queue, lambda jobs: reply, "test", F.expr("TIMESTAMP '2026-01-01'"))
    r = found.first()
    assert stats == {"extracted": 1, "missing": 1, "stopped": None}
    assert (r.role_family, r.seniority, r.years_experience_min, r.remote_policy, r.skills) == ("qa", "unknown", 3, "unknown", ["Python"])
    saved = enrich.save(found.withColumn("role_family", F.lit("other")), found).collect()
    assert [x.role_family for x in saved] == ["qa"]
    years = spark.createDataFrame([("3",), ('"3.7"',), ('" 4 "',), ("31",), ("null",), (None,), ("-1",), ("[1]",)], "y string")
    assert [x[0] for x in years.select(enrich.years(F.col("y"))).collect()] == [3, None, 4, None, None, None, None, None]
    assert enrich.extract(queue, None, "none", F.current_timestamp())[1]["stopped"] == "no model"


def test_allowance():
    now = [0.0]
    window = enrich.Allowance(100, lambda: now[0])
    assert window.delay(500) == 0
    window.record(80)
    assert window.delay(20) == 0 and window.delay(21) == 60
    now[0] = 61
    assert window.delay(100) == 0
    for n in (30, 30, 30):
        window.record(n)
        now[0] += 10
    assert window.delay(10) == 0 and window.delay(40) == 30 and window.delay(60) == 40 and window.delay(900) == 50


def test_calls_wait_and_are_tried_again():
    slept, now = [], [0.0]

    def sleep(seconds):
        slept.append(seconds)
        now[0] += seconds

    def model(answers):
        def reply(jobs):
            answer = answers.pop(0)
            if isinstance(answer, Exception):
                raise answer
            return answer

        return reply

    def asked(*answers, tokens=1000):
        return enrich.ask(model(list(answers)), [{"job_id": 1}], enrich.Allowance(tokens, lambda: now[0], sleep))

    assert asked("no json", None, ('{"jobs": []}', 7)) == '{"jobs": []}' and sum(slept) == 0
    slept.clear()
    assert asked(ConnectionError(), ConnectionError(), "{}") == "{}" and [s for s in slept if s] == [5, 10]
    slept.clear()
    assert asked(enrich.RateLimited(30), "{}") == "{}" and [s for s in slept if s] == [30, 30]  # the window was full
    assert asked(enrich.ModelRefused()) is None and asked("x", "x", "x", "x") is None
    with pytest.raises(enrich.QuotaExhausted):
        asked(enrich.RateLimited(121))


def test_batches_are_kept_when_a_run_breaks_off(spark, tmp_path, landed):
    root, calls = str(tmp_path / "data"), []

    def model(jobs):
        calls.append(jobs)
        if len(calls) == 2:
            raise OSError("gone")
        return json.dumps({"jobs": [{"id": j["job_id"], "role_family": "qa"} for j in jobs]})

    many = [LANDED["remoteok"][1] | {"id": str(k), "position": f"Developer {k}"} for k in range(6)]
    (tmp_path / "remoteok.json").write_text(json.dumps(many))
    with pytest.raises(OSError):
        pipeline.run(spark, root, {"remoteok": landed["remoteok"]}, model=model, as_of=as_of())
    assert pipeline.Store(spark, root).log("extractions", schema.EXTRACTIONS).count() == 4
    stats = pipeline.run(spark, root, None, model=model, as_of=as_of())
    assert stats["enrichment"] == {"extracted": 2, "missing": 0, "stopped": None} and len(calls) == 3
    assert pipeline.Store(spark, root).read("extractions", schema.EXTRACTIONS).count() == 6


def test_landed_pages(spark, tmp_path):
    """Pages as objects, the last of a key by page and position; malformed files and items without key fail their source."""
    for name, pages in {"arbeitnow": [{"data": [{"slug": "a", "v": 1}, {"slug": "b"}], "links": {"next": 1}}, {"data": [{"slug": "a", "v": 2}, {"slug": "a", "v": 3}]}], "remotive": [[{"id": 1}], '[{"id": 2}'], "adzuna_in": [{"results": [{"id": 1}, {"x": 1}]}]}.items():
        (tmp_path / name).mkdir()
        for k, page in enumerate(pages):
            (tmp_path / name / f"page{k}.json").write_text(page if isinstance(page, str) else json.dumps(page))
    paths = {n: str(tmp_path / n) for n in ("arbeitnow", "remotive", "adzuna_in")} | {"remoteok": str(tmp_path / "none")}
    for staging in (None, str(tmp_path / "staged")):
        rows, status = landing.read_sources(spark, paths, staging=staging)
        assert status == {"arbeitnow": "ok", "remotive": "failed: MalformedFile", "adzuna_in": "failed: MissingKey", "remoteok": "failed: AnalysisException"}
        last = {r.source_job_id: r.payload for r in bronze.latest_in_batch(rows).collect()}
        assert json.loads(last["a"])["v"] == 3 and set(last) == {"a", "b"}


def test_unknown_sources_go_to_the_quarantine(spark):
    raw = spark.createDataFrame([(1, "elsewhere", "1", "{}")], "raw_id long, source string, source_job_id string, payload string")
    good, bad = silver.split_quarantine(silver.to_silver(raw))
    assert good.count() == 0 and bad.first().parse_errors == [silver.NO_MAPPER]


def test_metrics(spark):
    rows = spark.createDataFrame([(["a", "b"], ["a", "c"]), (["d"], ["d"]), ([], [])], "gold array<string>, pred array<string>")
    got = evaluate.set_scores(rows).first()
    assert (got.precision, got.recall, got.f1, got.tp, got.fp, got.fn) == (0.667, 0.667, 0.667, 2, 1, 1)
    assert [tuple(r) for r in evaluate.per_skill_errors(rows).collect()] == [("false_positive", "c", 1), ("false_negative", "b", 1)]
    flat = spark.createDataFrame([("x", "x"), ("y", None), ("", "y"), (None, "z")], "gold string, pred string")
    assert evaluate.accuracy(flat).first()[0] == 0.5 and evaluate.accuracy(flat.where("gold = ''")).first()[0] is None
    nothing = evaluate.set_scores(rows.limit(0)).first()
    assert (nothing.precision, nothing.tp) == (0.0, 0)


def test_sync_and_search(spark):
    docs = spark.createDataFrame([(1, "python data", "a"), (2, "java web", "b"), (3, "go", "c")], "job_id long, document string, doc_hash string")
    first, counts = vectors.sync(spark.createDataFrame([], schema.VECTORS), docs)
    assert tuple(counts.first()) == (3, 0)
    first = first.cache()
    changed = docs.where("job_id <> 3").withColumn("doc_hash", F.when(F.col("job_id") == 2, "z").otherwise(F.col("doc_hash")))
    second, counts = vectors.sync(first, changed)
    assert tuple(counts.first()) == (1, 1) and second.count() == 2
    asked = vectors.hashed_embedding(spark.createDataFrame([(0, "data python")], "query_id int, t string"), "t")
    hit = vectors.search(first, asked, 1).first()
    assert (hit.job_id, hit.similarity) == (1, 1.0)
    hits = spark.createDataFrame([(0, 1, 0.9), (1, 1, 0.5), (2, 1, 0.1), (0, 2, 0.4)], "query_id int, job_id long, exact double")
    assert {r.job_id: r.semantic for r in vectors.semantic_scores(hits).collect()} == {1: 0.7, 2: 0.4}


def test_dq_ledger(spark):
    a = spark.createDataFrame([(1, "c", "error", False, 5, "d", None)], schema.DQ)
    b = spark.createDataFrame([(1, "c", "warn", True, 0, "e", None)], schema.DQ)
    assert [tuple(r)[:6] for r in quality.record(a, b).collect()] == [(1, "c", "error", True, 0, "d")]


def test_stream(spark, tmp_path):
    from sluice.streaming.ingest import upsert_stream

    landed, root, check = (str(tmp_path / x) for x in ("landed", "root", "check"))
    spark.createDataFrame([("s", "1", "{}", 0)], landing.RAW).write.parquet(landed)
    upsert_stream(spark, landed, root, check).awaitTermination()
    spark.createDataFrame([("s", "2", "{}", 0)], landing.RAW).write.mode("append").parquet(landed)
    upsert_stream(spark, landed, root, check).awaitTermination()
    assert pipeline.Store(spark, root).read("bronze", schema.BRONZE).count() == 2


def test_duplicates_are_keyed_once(spark, tmp_path):
    rows = [(1, "A b", "src9", 5), (2, "a  B!", "src3", 1), (3, "a (m/w/d) b", "src3", 9), (4, "c", "src1", None), (4, "A-B", "src1", None), (5, "C.", "src1", 2), (7, "é", "src3", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    flagged = catalogue.QUERIES["dedupe_flag"](spark, str(tmp_path))
    assert sorted((r.doc_id, r.is_duplicate) for r in flagged.collect()) == [(1, True), (2, True), (3, False), (4, True), (4, True), (5, False), (7, False)]
    assert flagged._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_silver_of_nothing(spark):
    assert silver.to_silver(spark.createDataFrame([], schema.BRONZE)).count() == 0


def test_search_of_every_twentieth_row(spark, tmp_path):
    x = np.random.default_rng(3).normal(size=(300, 8)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = {(q, int(j), r + 1) for q in range(0, 300, 20) for r, j in enumerate(np.argsort(-(unit @ unit[q]), kind="stable")[:10])}
    got = catalogue.QUERIES["knn_cosine"](spark, str(tmp_path)).collect()
    assert {(r.query_id, r.job_id, r["rank"]) for r in got} == want and len(got) == 150
    found = frame.withColumnRenamed("vec_id", "job_id")
    blocks = vectors.search(found, found.where("job_id % 20 = 0").withColumnRenamed("job_id", "query_id"), 10, block=4).collect()
    assert {(r.query_id, r.job_id, r["rank"]) for r in blocks} == want


def test_search_of_odd_vectors_in_many_blocks(spark, monkeypatch):
    import duckdb

    x = np.random.default_rng(5).normal(size=(400, 6)).astype(np.float32)
    x[40:80], x[80:90], x[3] = x[0], 3 * x[0], 0  # copies, a longer copy and nothing at all
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (401, [])]
    found = spark.createDataFrame(rows, "job_id long, embedding array<float>")
    asked = found.where("job_id % 20 = 0 or job_id in (3, 401)").withColumnRenamed("job_id", "query_id")
    with duckdb.connect() as db:
        db.execute("CREATE TABLE v (id BIGINT, e DOUBLE[])")
        db.executemany("INSERT INTO v VALUES (?, ?)", rows)
        scored = "SELECT q.id AS q, v.id, CASE WHEN len(v.e) = len(q.e) THEN list_cosine_similarity(v.e, q.e) END AS c FROM v, v q WHERE q.id % 20 = 0 OR q.id IN (3, 401)"
        want = db.execute(f"SELECT q, id, row_number() OVER (PARTITION BY q ORDER BY c DESC NULLS LAST, id) AS r, c FROM ({scored}) QUALIFY r <= 12 ORDER BY q, r").fetchall()
    monkeypatch.setattr(vectors, "VECTORS", 90)
    hits = vectors.search(found, asked, 12, block=7)
    assert "NestedLoopJoin" not in hits._jdf.queryExecution().toString() and "CartesianProduct" not in hits._jdf.queryExecution().toString()
    got = [(r.query_id, r.job_id, r["rank"], r.exact) for r in hits.orderBy("query_id", "rank").collect()]
    assert len(got) == len(want) == 23 * 12 and str(got) == str(want)  # to the last bit; NaN equals itself as text


def test_nearest_past_the_first_parts():
    x = np.random.default_rng(6).normal(size=(900, 5)).astype(np.float32)
    x[100:200] = x[7]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    sizes = nearest.QUERIES, nearest.VECTORS
    try:
        nearest.QUERIES, nearest.VECTORS = 16, 64
        q, v, _ = nearest.best(x[::9], x, 20)
    finally:
        nearest.QUERIES, nearest.VECTORS = sizes
    want = np.argsort(-np.round(unit[::9] @ unit.T, 12), axis=1, kind="stable")[:, :20]
    assert (v.reshape(-1, 20) == want).all() and (q == np.repeat(np.arange(100), 20)).all()


def test_blocks_of_a_search():
    assert vectors.blocks(0, 0, 5000, 8) == (1, 1) and vectors.blocks(2000, 100, 5000, 8) == (1, 1)
    assert vectors.blocks(100_000, 5000, 5000, 12) == (5, 5) and vectors.blocks(6_000_000, 300_000, 5000, 12) == (46, 60)


def test_match_of_copies_and_of_an_empty_vector(spark, tmp_path):
    import duckdb

    x = np.random.default_rng(8).normal(size=(200, 8)).astype(np.float32)
    x[50:60], x[60:70], x[33] = x[20], 5 * x[20], 0
    spark.createDataFrame([(i, v.tolist(), i % 10) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        want = db.execute(catalogue.ORACLES["match_rerank"]).fetchall()
    assert str([tuple(r) for r in catalogue.QUERIES["match_rerank"](spark, str(tmp_path)).collect()]) == str(want)


def test_evaluation(spark, tmp_path):
    rows = [(k, "s", str(k), "Data Engineer", "C", "L", "We use Python and SQL daily. " * 9, True, k == 3) for k in range(5)]
    kinds = "job_id long, source string, source_job_id string, title string, company string, location string, description string, is_tech boolean, is_duplicate boolean"
    labels = evaluate.sample_for_labels(spark.createDataFrame(rows, kinds), 3)
    drawn = sorted(r.id for r in labels.collect())
    assert len(drawn) == 3 and "s:3" not in drawn
    path = tmp_path / "labels.jsonl"
    path.write_text("".join(json.dumps(r.asDict()) + "\n" for r in labels.collect()))
    answers = iter(["python, cobol", "no", "qa", "senior"] + ["Python, SQL", "data_engineer", "mid"] * 2)
    pipeline.label_file(str(path), lambda question: next(answers))
    done = landing.read_labels(spark, str(path))
    assert done.where("labelled").count() == 3

    def model(jobs):
        return json.dumps({"jobs": [{"id": j["job_id"], "role_family": "qa", "seniority": "mid", "skills": ["python"]} for j in jobs]})

    report = evaluate.evaluate(done, model, "m")
    assert report["jobs"] == report["answered"] == 3 and report["role_family_accuracy"] == 0.333 and report["seniority_accuracy"] == 0.667
    assert (report["skills"]["keyword"]["tp"], report["skills"]["keyword"]["fp"]) == (5, 1) and report["skills"]["model"]["recall"] == 0.6
    evaluate.write_report(report, str(tmp_path))
    assert "model" in (tmp_path / "results.md").read_text() and json.loads((tmp_path / "results.json").read_text())["jobs"] == 3
    assert evaluate.evaluate(done)["answered"] == 0
