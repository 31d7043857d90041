"""Raw payloads to typed, clean records: four mappings, one shared projection, duplicates across sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import schema
from sluice.functions import fixed, moment, place, salary, skills, text

#: Keys that the mappings read, as strings whatever their JSON type; others stay in the payload.
PAYLOADS = {
    "remotive": "title string, company_name string, candidate_required_location string, job_type string, salary string, publication_date string, url string, description string",
    "arbeitnow": "title string, company_name string, location string, remote string, job_types array<string>, created_at string, url string, description string",
    "remoteok": "position string, company string, location string, tags array<string>, salary_min string, salary_max string, date string, url string, description string",
    "adzuna_in": "title string, description string, company struct<display_name:string>, location struct<display_name:string>, salary_min string, salary_max string, salary_is_predicted string, created string, contract_time string, contract_type string, redirect_url string",
}


#: What a mapping gives.
MAPPED = "title string, company string, location string, country string, is_remote boolean, employment_type string, salary_min double, salary_max double, salary_currency string, salary_period string, posted string, url string, html string, bad_amount boolean"
NO_MAPPER = "no mapping of this source"


def _truthy(value: Column) -> Column:
    return F.coalesce(~F.lower(value).isin("", "false", "0", "0.0", "null", "[]", "{}"), F.lit(False))


def from_remotive(p: Column) -> dict[str, Column]:
    where, pay = p["candidate_required_location"], salary.parse_salary(p["salary"])
    return {
        "title": p["title"], "company": p["company_name"], "location": where, "country": place.guess_country(where, "REMOTE"), "is_remote": F.lit(True),
        "employment_type": place.employment_type(F.array(p["job_type"])),
        "salary_min": pay["lo"], "salary_max": pay["hi"], "salary_currency": pay["currency"], "salary_period": pay["period"],
        "posted": p["publication_date"], "url": p["url"], "html": p["description"],
    }


def from_arbeitnow(p: Column) -> dict[str, Column]:
    return {
        "title": p["title"], "company": p["company_name"], "location": p["location"], "country": place.guess_country(p["location"], "DE"),
        "is_remote": _truthy(p["remote"]), "employment_type": place.employment_type(p["job_types"]),
        "posted": p["created_at"], "url": p["url"], "html": p["description"],
    }


def from_remoteok(p: Column) -> dict[str, Column]:
    lo, hi = salary.stated(p["salary_min"]), salary.stated(p["salary_max"])
    hourly = F.coalesce(lo < 1000, F.lit(False))  # an hourly rate in a yearly field
    lo, hi = F.when(~hourly, lo), F.when(~hourly, hi)
    return {
        "title": F.coalesce(p["position"], F.lit("")), "company": p["company"], "location": F.coalesce(F.nullif(p["location"], F.lit("")), F.lit("Remote")),
        "country": place.guess_country(p["location"], "REMOTE"), "is_remote": F.lit(True), "employment_type": place.employment_type(p["tags"]),
        "salary_min": lo, "salary_max": hi, "salary_currency": F.when(lo.isNotNull(), "USD"), "salary_period": F.when(lo.isNotNull(), "year"),
        "posted": p["date"], "url": p["url"], "html": p["description"], "bad_amount": _unread(p["salary_min"], p["salary_max"]),
    }


def from_adzuna(p: Column) -> dict[str, Column]:
    real = F.coalesce(p["salary_is_predicted"] != "1", F.lit(True))
    lo, hi = (F.when(real, p[c].try_cast("double")) for c in ("salary_min", "salary_max"))
    given = F.coalesce(lo != 0, F.lit(False))
    words = F.lower(F.concat(F.coalesce(p["title"], F.lit("")), F.coalesce(p["description"], F.lit(""))))
    return {
        "title": F.coalesce(p["title"], F.lit("")), "company": p["company"]["display_name"], "location": p["location"]["display_name"], "country": F.lit("IN"),
        "is_remote": words.rlike(fixed.REMOTE_WORDS), "employment_type": place.employment_type(F.array(p["contract_time"], p["contract_type"])),
        "salary_min": lo, "salary_max": F.when(~lo.eqNullSafe(hi), hi), "salary_currency": F.when(given, "INR"), "salary_period": F.when(given, "year"),
        "posted": p["created"], "url": p["redirect_url"], "html": p["description"], "bad_amount": real & _unread(p["salary_min"], p["salary_max"]),
    }


#: A parsed payload to the columns of MAPPED; those that a mapping leaves out are null.
MAPPERS = {"remotive": from_remotive, "arbeitnow": from_arbeitnow, "remoteok": from_remoteok, "adzuna_in": from_adzuna}


def mapped(payload: Callable[[str], Column]) -> list[Column]:
    """MAPPED's columns, each as the mapping of a row's source makes it of its payload."""
    made = {source: mapper(payload(source)) for source, mapper in MAPPERS.items()}
    out = []
    for name, kind in (f.split() for f in MAPPED.split(", ")):
        value = F.lit(None)
        for source, columns in made.items():
            if name in columns:
                value = F.when(F.col("source") == source, columns[name].cast(kind)).otherwise(value)
        out.append(value.cast(kind).alias(name))
    return out


def _unread(*raw: Column) -> Column:
    """Whether a value is stated but is no number."""
    out = F.lit(False)
    for r in raw:
        out = out | F.coalesce((r != "") & r.try_cast("double").isNull(), F.lit(False))
    return out


def to_silver(bronze: DataFrame, clean_title: bool = False, drop_script: bool = False) -> DataFrame:
    """Typed records with parse_errors (empty where all could be read). Bronze is scanned once: a row's payload is
    parsed and mapped as its source says; rows of a source without mapping get that as their error."""
    parsed = bronze.withColumns({f"__{s}": F.when(F.col("source") == s, F.from_json("payload", keys)) for s, keys in PAYLOADS.items()})
    unmapped = ~F.coalesce(F.col("source").isin(*MAPPERS), F.lit(False))
    rows = parsed.select("raw_id", "source", "source_job_id", unmapped.alias("unmapped"), *mapped(lambda s: F.col(f"__{s}")))
    reader = text.html_to_text_without_scripts if drop_script else text.html_to_text
    read = rows.withColumn("description", text.fix_mojibake(reader(F.col("html"))))
    title = F.regexp_replace(F.col("title"), "<[^>]*>", "") if clean_title else F.col("title")
    read = read.withColumns({
        "title": text.unescape_entities(text.fix_mojibake(title)),
        "company": text.fix_mojibake(F.col("company")),
        "location": text.fix_mojibake(F.col("location")),
        "posted_at": moment.parse_moment(F.col("posted")),
    })
    unreadable = F.coalesce(~F.col("posted").isin("", "0") & F.col("posted_at").isNull(), F.lit(False))
    reasons = F.array(
        F.when(F.col("unmapped"), NO_MAPPER).when(F.col("title").isNull(), "title missing"),
        F.when(F.coalesce("bad_amount", F.lit(False)), "salary is no number"),
        F.when(unreadable, "date can't be read"),
    )
    usd = lambda c: salary.to_usd_year(F.col(c), F.col("salary_currency"), F.col("salary_period"))
    done = read.withColumns({
        "job_id": F.col("raw_id"),
        "salary_usd_year_min": usd("salary_min"),
        "salary_usd_year_max": usd("salary_max"),
        "salary_min": F.col("salary_min").cast(salary.MONEY),
        "salary_max": F.col("salary_max").cast(salary.MONEY),
        "content_hash": text.content_hash(F.col("title"), F.col("company"), F.col("description")),
        "dedupe_key": text.dedupe_key(F.col("company"), F.col("title")),
        "is_tech": skills.is_tech_title(F.col("title")),
        "keyword_skills": skills.keyword_skills(F.concat(F.col("title"), F.lit("\n"), F.col("description"))),
        "parse_errors": F.array_compact(reasons),
    })
    return done.drop("posted", "html", "bad_amount", "unmapped")


def split_quarantine(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rows with a reason)."""
    good = F.size("parse_errors") == 0
    return records.where(good).drop("parse_errors"), records.where(~good)


def source_rank(source: Column, priority=None) -> Column:
    pairs = (priority or fixed.SOURCE_PRIORITY).items()
    return F.coalesce(*(F.when(source == name, rank) for name, rank in pairs), F.lit(len(pairs) + 1))


def newest_first(moment: Column) -> Column:
    """Sorts upwards as the moment sorts downwards, missing ones last."""
    return F.coalesce(-F.unix_micros(moment), F.lit((1 << 63) - 1))


def flag_duplicates(records: DataFrame, key: str = "dedupe_key", order=None, row: Column | None = None) -> DataFrame:
    """is_duplicate: all but the first of a key by ``order`` (source priority, newest, id). The first is found by
    aggregation, so a key that very many rows share doesn't meet in one task; keys meet as digests. Records find
    themselves among the first by their places in the order, so that the key is made once. ``row`` tells apart the rows
    of one place (an id that stands twice); it follows from what the key is made of, or is the key."""
    order = order or [source_rank(F.col("source")), newest_first(F.col("posted_at")), F.col("job_id")]
    places = [c.alias(f"__o{i}") for i, c in enumerate([*order, F.xxhash64(key) if row is None else row])]
    names = [f"__o{i}" for i in range(len(places))]
    digest = F.sha2(F.coalesce(F.col(key), F.lit("")), 256).alias("__key")
    first = records.select(digest, F.struct(*places).alias("__at")).groupBy("__key").agg(F.min("__at").alias("__first")).select("__first.*", F.lit(False).alias("__later"))
    marked, first = records.select("*", *places).alias("m"), first.alias("f")
    found = marked.join(first, [F.col(f"m.{n}").eqNullSafe(F.col(f"f.{n}")) for n in names], "left")
    return found.select(*(F.col(f"m.`{c}`") for c in records.columns), F.coalesce("__later", F.lit(True)).alias("is_duplicate"))


def build_silver(bronze: DataFrame, previous: DataFrame, at: Column, keep: Callable[[DataFrame], DataFrame] = lambda frame: frame, **options) -> tuple[DataFrame, DataFrame]:
    """(next silver snapshot, quarantine). updated_at moves only where a record changed. ``keep`` may write the mapped
    records down, so that both are made from one reading."""
    good, bad = split_quarantine(keep(to_silver(bronze, **options)))
    flagged = flag_duplicates(good)
    compared = [c for c in flagged.columns if c not in ("job_id", "raw_id")]
    state = F.xxhash64(*compared)
    old = previous.select("job_id", F.xxhash64(*compared).alias("was"), F.col("updated_at").alias("since"))
    joined = flagged.withColumn("is_now", state).join(old, "job_id", "left")
    out = joined.withColumn("updated_at", F.when(F.col("was") == F.col("is_now"), F.col("since")).otherwise(at))
    return out.select(*(c.split()[0] for c in schema.SILVER.split(", "))), bad
