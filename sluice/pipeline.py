"""The batch run and the command line: ingest, silver, enrichment, gate, gold, vectors."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schema
from sluice.functions import fixed
from sluice.operators import bronze, dashboard, enrich, evaluate, gold, ledger, quality, silver, vectors
from sluice.session import get_session
from sluice.sources import landing


class Store:
    """Versioned Parquet snapshots under a root that Spark can write. A version counts once its marker is appended; the
    last ``KEPT`` are kept for their readers."""

    KEPT = 3

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _current(self, name: str) -> int | None:
        try:
            return self.spark.read.schema("version long").parquet(f"{self.root}/{name}/current").agg(F.max("version")).first()[0]
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def read(self, name: str, ddl: str) -> DataFrame:
        version = self._current(name)
        if version is None:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(f"{self.root}/{name}/v{version}")

    def append(self, name: str, frame: DataFrame) -> None:
        """Rows kept from now on, whatever becomes of the run; the next version takes them in."""
        frame.write.mode("append").parquet(f"{self.root}/{name}/log")

    def stage(self, name: str, frame: DataFrame) -> DataFrame:
        """The frame, written down and read back."""
        frame.write.mode("overwrite").parquet(f"{self.root}/staging/{name}")
        return self.spark.read.schema(frame.schema).parquet(f"{self.root}/staging/{name}")

    def log(self, name: str, ddl: str) -> DataFrame:
        try:
            return self.spark.read.schema(ddl).parquet(f"{self.root}/{name}/log")
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], ddl)
            raise

    def write(self, name: str, frame: DataFrame, ddl: str) -> DataFrame:
        """A new version; the one before stays readable while this one is made from it."""
        version = (self._current(name) or 0) + 1
        frame.select(*(c.split()[0] for c in ddl.split(", "))).write.parquet(f"{self.root}/{name}/v{version}")
        self.spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{self.root}/{name}/current")
        old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/v{version - self.KEPT}")
        old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        return self.read(name, ddl)


def run(spark: SparkSession, root: str, paths: dict[str, str | None] | None = None, model=None, model_name: str = "none", llm_limit: int = fixed.JOBS_PER_RUN, as_of=None) -> dict:
    """One run. ``paths`` None skips ingestion. Returns its statistics; raises after recording a failure."""
    store, as_of = Store(spark, root), as_of if as_of is not None else F.current_timestamp()
    runs = store.read("runs", schema.RUNS)
    run_id, stats = ledger.next_run_id(runs), {}
    events = runs.unionByName(ledger.event(spark, run_id, "running"))
    events = store.write("runs", events, schema.RUNS)
    try:
        raw = store.read("bronze", schema.BRONZE)
        if paths is not None:
            batch, stats["sources"] = landing.read_sources(spark, paths, staging=f"{root}/staging/run{run_id}")
            upserted = bronze.upsert_raw(raw, batch, run_id, as_of)
            stats["ingest"] = bronze.change_counts(upserted).first().asDict()
            raw = store.write("bronze", upserted, schema.BRONZE)
        records, quarantine = silver.build_silver(raw, store.read("silver", schema.SILVER), as_of, keep=lambda frame: store.stage(f"mapped{run_id}", frame))
        records = store.write("silver", records, schema.SILVER)
        stats |= {"silver": records.count(), "quarantined": quarantine.count(), "duplicates": records.where("is_duplicate").count(), "unique_tech": records.where("is_tech and not is_duplicate").count()}
        done = enrich.save(store.read("extractions", schema.EXTRACTIONS), store.log("extractions", schema.EXTRACTIONS))
        queue = enrich.work_queue(records, done, limit=llm_limit)
        _, stats["enrichment"] = enrich.extract(queue, model, model_name, as_of, commit=lambda rows: store.append("extractions", rows))
        done = store.write("extractions", enrich.save(done, store.log("extractions", schema.EXTRACTIONS)), schema.EXTRACTIONS)
        results = quality.run_checks(records, done, run_id, as_of)
        checked = store.write("dq", quality.record(store.read("dq", schema.DQ), results), schema.DQ)
        stats["blocked_by"] = quality.blocking(checked.where(F.col("run_id") == run_id))
        if stats["blocked_by"]:
            raise RuntimeError("quality gate: " + ", ".join(stats["blocked_by"]))
        gold.publish(spark, gold.build(records, done), f"{root}/gold", run_id)
        jobs = gold.published(spark, f"{root}/gold", "jobs_enriched")
        synced, counts = vectors.sync(store.read("vectors", schema.VECTORS), vectors.documents(jobs, records))
        stats["vectors"] = counts.first().asDict()
        store.write("vectors", synced, schema.VECTORS)
    except Exception as error:
        store.write("runs", ledger.fold(events.unionByName(ledger.event(spark, run_id, "failed", stats, str(error)[:500]))), schema.RUNS)
        raise
    store.write("runs", ledger.fold(events.unionByName(ledger.event(spark, run_id, "success", stats))), schema.RUNS)
    return stats


def search(spark: SparkSession, root: str, query: str, n: int = 10) -> DataFrame:
    asked = vectors.hashed_embedding(spark.createDataFrame([(0, query)], "query_id int, text string"), "text")
    hits = vectors.search(Store(spark, root).read("vectors", schema.VECTORS), asked, n)
    return dashboard.hit_lookup(hits, gold.published(spark, f"{root}/gold", "jobs_enriched"))


def match(spark: SparkSession, root: str, resume: DataFrame, n: int = 15) -> DataFrame:
    return vectors.match(resume, Store(spark, root).read("vectors", schema.VECTORS), gold.published(spark, f"{root}/gold", "jobs_enriched"), n)


def label_file(path: str, ask=input) -> None:
    """Labels what is not yet labelled in a local file of JSON lines; each answer is saved at once."""
    canonical = {n.lower(): c for c, more in fixed.SKILLS.items() for n in (c, *more)}
    with open(path, encoding="utf-8") as lines:
        records = [json.loads(x) for x in lines if x.strip()]
    for i, record in enumerate(records):
        if not record["labelled"]:
            records[i] = evaluate.label(record, ask, lambda name: canonical.get(name.strip().lower()))
            with open(path, "w", encoding="utf-8") as out:
                out.writelines(json.dumps(r, ensure_ascii=False) + "\n" for r in records)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sluice")
    parser.add_argument("--root", default="./sluice-data")
    commands = parser.add_subparsers(dest="command", required=True)
    go = commands.add_parser("run")
    go.add_argument("--llm-limit", type=int, default=fixed.JOBS_PER_RUN)
    go.add_argument("--skip-ingest", action="store_true")
    for source in landing.READERS:
        go.add_argument(f"--{source}", help="path of landed JSON")
    for name, what, most in (("match", "resume", 15), ("search", "query", 10)):
        sub = commands.add_parser(name)
        sub.add_argument(what)
        sub.add_argument("-n", type=int, default=most)
    draw = commands.add_parser("sample", help="writes records to label as JSON lines")
    draw.add_argument("out")
    draw.add_argument("-n", type=int, default=50)
    draw.add_argument("--seed", type=int, default=42)
    asked = commands.add_parser("label", help="asks for the labels of a local file of JSON lines")
    asked.add_argument("file")
    scored = commands.add_parser("evaluate", help="writes results.json and results.md")
    scored.add_argument("labels")
    scored.add_argument("--out", default=".")
    args = parser.parse_args(argv)
    if args.command == "label":
        label_file(args.file)
        return 0
    spark = get_session("sluice")
    if args.command == "run":
        paths = None if args.skip_ingest else {s: getattr(args, s) for s in landing.READERS}
        try:
            print(run(spark, args.root, paths, llm_limit=args.llm_limit))
        except RuntimeError as error:
            print(error, file=sys.stderr)
            return 1
    elif args.command == "search":
        search(spark, args.root, args.query, args.n).select("rank", "similarity", "title", "company").show(args.n, False)
    elif args.command == "sample":
        landing.write_labels(evaluate.sample_for_labels(Store(spark, args.root).read("silver", schema.SILVER), args.n, args.seed), args.out)
    elif args.command == "evaluate":
        evaluate.write_report(evaluate.evaluate(landing.read_labels(spark, args.labels)), args.out)
    else:
        found = match(spark, args.root, landing.read_resume(spark, args.resume), args.n)
        found.show(args.n, False)
        dashboard.gap_ranking(found).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
