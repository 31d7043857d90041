import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.functions import fixed, moment, place, salary, skills, text


def values(spark, rows, kind, expression):
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


SALARIES = {
    "$20k -$35k": (20000, 35000, "USD", "year"), "$90 - $150 /hour": (90, 150, "USD", "hour"), "$90 - 150k": (90000, 150000, "USD", "year"),
    "€60,000": (60000, None, "EUR", "year"), "60.000 €": (60000, None, "EUR", "year"), "£4,000 per month": (4000, None, "GBP", "month"),
    "INR 12,00,000": (1200000, None, "INR", "year"), "": None, "Competitive": None, "$5 equity": None, "1.2.3": None, None: None,
}


def test_salaries(spark):
    got = values(spark, list(SALARIES), "string", salary.parse_salary)
    assert [None if g is None else tuple(g) for g in got] == list(SALARIES.values())


def test_usd(spark):
    rows = [(50.0, "USD", "hour"), (1000.0, "EUR", "month"), (1.0, "XXX", "year"), (None, "USD", "year"), (1.0, "USD", None)]
    frame = spark.createDataFrame(rows, "a double, c string, p string")
    got = [r[0] for r in frame.select(salary.to_usd_year(F.col("a"), F.col("c"), F.col("p"))).collect()]
    assert [None if g is None else float(g) for g in got] == [104000, 13920, None, None, None]


def test_places(spark):
    rows = ["Bengaluru, India", "Remote - USA", "Düsseldorf", "Worldwide", "London, UK", "Nowhere", None, "MÜNCHEN"]
    assert values(spark, rows, "string", lambda x: place.guess_country(x, "??")) == ["IN", "US", "DE", "REMOTE", "GB", "??", "??", "DE"]


def test_employment(spark):
    rows = [["x", " Full-Time "], ["Working student", "intern"], [None], None, []]
    assert values(spark, rows, "array<string>", place.employment_type) == ["full_time", "part_time", None, None, None]


def test_skills(spark):
    rows = ["Python, C++ and Node.js; CI/CD with golang", "You will excel in R&D and react quickly to html changes", "SQL sql Spring boot spring", "ÉGo Go", None, "R, Go"]
    assert values(spark, rows, "string", skills.keyword_skills) == [["C++", "CI/CD", "Go", "Node.js", "Python"], [], ["SQL", "Spring"], ["Go"], [], ["Go", "R"]]
    assert values(spark, [[" PYTHON ", "k8s", "cobol", None], None], "array<string>", skills.canonicalise) == [["Kubernetes", "Python"], []]
    assert len(fixed.SKILLS) == 82 and sum(1 + len(v) for v in fixed.SKILLS.values()) == 136
    find = skills.matcher()
    assert sorted(find(rows[0])) == ["C++", "CI/CD", "Go", "Node.js", "Python"]


def test_titles(spark):
    assert values(spark, ["Data Engineer", "IT Support", "it must be", "Nurse", None], "string", skills.is_tech_title) == [True, True, False, False, False]


def test_html():
    assert text.plain_text("<p>Hi <b>you</b></p><ul><li>one</li><li>two</li></ul>") == "Hi you\n\n- one\n- two"  # the list and its first item each start a line
    assert text.plain_text("&lt;p&gt;Hello&lt;/p&gt;") == "Hello"
    assert text.plain_text("<div>&lt;p&gt;in&lt;br&gt;side&lt;/p&gt;</div>") == "in\nside"
    assert text.plain_text("a &amp; b\t  c\n\n \n\nd") == "a & b c\n\nd" and text.plain_text(None) == ""
    assert "x=1" in text.plain_text("<script>x=1</script>t") and text.plain_text("<script>x=1</script>t", drop_script=True) == "t"


def test_entities_that_are_cut_off(spark):
    pages = ["<title>a &amp; b &amp</title>x", "<title>que &am</title><style>p{}</style>", "&copy &quot; &#39; &#x41; &nosuch; &eacute;<br>&lt", None]
    want = ["a & b &ampx", "que &amp{}", "&copy \" ' A &nosuch; é\n&lt", None]
    assert values(spark, pages, "string", text.html_to_text_closed) == want
    assert text.plain_text(pages[0]) == "a & b &x"  # postings are read as ever


def test_mojibake(spark):
    broken = "â\u0080\u0094 Ã©".encode("latin-1").decode("latin-1")
    assert values(spark, [broken, "plain", "Ã© 漢", "Ã\u0080ÿ", None], "string", text.fix_mojibake) == ["— é", "plain", "Ã© 漢", "Ã\u0080ÿ", None]


def test_keys(spark):
    frame = spark.createDataFrame([("Acme GmbH & Co. KG", "Data Engineer (m/w/d) C++"), ("Düsseldorf AG", "m/w/d Tester"), (None, None)], "c string, t string")
    assert [r[0] for r in frame.select(text.dedupe_key(F.col("c"), F.col("t"))).collect()] == ["acme kg|data engineer c++", "d sseldorf|tester", "|"]


def test_gender_tags_of_titles(spark):
    titles = ["Dev (m/w/d)", "Dev (ALL)", "Dev (M / F / X) x", "Dev m/f/d", "xm/f/d Dev", "Dev (abc) m/z/d", "Dev w/M/X.", "Dev (m\u00a0/\u2003w)", "(x)(d)Dev", "Dev \u0131m/w/d"]
    want = ["dev", "dev", "dev x", "dev", "xm f d dev", "dev abc m z d", "dev", "dev", "dev", "dev m w d"]
    assert values(spark, titles, "string", text.norm_title) == want


def test_excerpts_and_chunks(spark):
    long = "We are great. " * 40
    posting = f"{long}\n\nRequirements: Python and SQL\n\n{long}\n- Kafka"
    assert text.best_paragraphs(posting, 60) == "Requirements: Python and SQL\n\n- Kafka" and text.best_paragraphs("short", 60) == "short"
    assert text.best_paragraphs("x" * 100, 10) == "x" * 10
    texts = ["a" * 500 + "\n\n" + "b" * 300 + "\nc", "", None, " \n ", "x" * 900, "y" * 701 + "\n"]
    want = [["a" * 500 + "\n", "b" * 300 + "\nc\n"], [""], [""], [" \n "], ["x" * 900 + "\n"], ["y" * 701 + "\n"]]
    assert values(spark, texts, "string", text.chunk_text) == want


def test_paragraphs_are_searched_only_for_what_their_text_holds(monkeypatch):
    posting = "We \u017fql a\u212bre kaf\u212aa great.\n\nYOUR PROF\u0130LE: l\u0131nux\n\nGo, .NET and C++\n\nno go here, RR\n\nrest ap\u0131, A/B te\u017fting"
    find, every = skills.matcher(posting), {c: [re.compile(p, 0 if case else re.IGNORECASE) for n, p, case in skills.patterns() if n == c] for c in fixed.SKILLS}
    for part in posting.split("\n\n"):
        assert find(part) == skills.matcher()(part) == {c for c, some in every.items() if any(p.search(part) for p in some)}
    assert text.best_paragraphs(posting, 30) == "YOUR PROF\u0130LE: l\u0131nux"
    assert all(re.search(fixed.HEADINGS, x) for x in ("what youll need", "were looking for", *(p for p in fixed.HEADING_PIECES if p not in ("ll need", "re looking for"))))
    monkeypatch.setattr(skills, "_compiled", lambda: dict.fromkeys(["python"], [("Python", None)]))
    assert text.best_paragraphs("Nothing of it.\n\n" * 20, 20) == "Nothing of it."  # no pattern is tried


def test_moments(spark):
    rows = ["1790000000", "20261002", "2026-01-02T03:04:05Z", "2026-01-02T03:04:05+02:00", "2026-01-02", "", "0", None, "soon"]
    got = values(spark, rows, "string", lambda x: moment.parse_moment(x).cast("timestamp_ntz"))
    want = [datetime(2026, 9, 21, 14, 13, 20), datetime(1970, 8, 23, 12, 3, 22), datetime(2026, 1, 2, 3, 4, 5), datetime(2026, 1, 2, 1, 4, 5), datetime(2026, 1, 2), None, None, None, None]
    assert got == want


@pytest.mark.parametrize("length, tokens", [(0, 0), (2, 0), (9, 3)])
def test_token_estimate(spark, length, tokens):
    assert values(spark, ["x" * length], "string", text.estimate_tokens) == [tokens]
