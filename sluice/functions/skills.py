"""Dictionary matching of a vocabulary: one alternation per canonical name and case rule."""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions import fixed

BEFORE, AFTER = r"(?<![\w+#&.])", r"(?![\w+#&])"


def patterns(vocabulary=None, exact=None) -> list[tuple[str, str, bool]]:
    """(canonical name, pattern, whether case counts)."""
    vocabulary, exact = vocabulary or fixed.SKILLS, fixed.CASE_SENSITIVE if exact is None else exact
    out = []
    for canonical, more in vocabulary.items():
        for case in (True, False):
            names = [n for n in (canonical, *more) if (n in exact) == case]
            if names:
                out.append((canonical, BEFORE + "(?:" + "|".join(map(re.escape, names)) + ")" + AFTER, case))
    return out


#: Letters that ignoring case takes for an ASCII letter, beside its upper case.
FOLDED = (("\u0130", "i"), ("\u0131", "i"), ("\u017f", "s"), ("\u212a", "k"))
WORD = re.compile(r"\w+")


def lowered(text: str) -> str:
    """Lower case in which every ASCII letter stands that a search without case would find."""
    for letter, instead in () if text.isascii() else FOLDED:
        text = text.replace(letter, instead)
    return text.lower()


@lru_cache(maxsize=1)
def _compiled():
    """First word, in lower case -> [(canonical name, pattern)]. BEFORE and AFTER let a name begin and end only where its
    first word is a whole word of the text."""
    out: dict[str, list] = {}
    for canonical, more in fixed.SKILLS.items():
        for name in (canonical, *more):
            if not name.isascii():
                raise ValueError(f"not an ASCII name: {name}")
            case = 0 if name in fixed.CASE_SENSITIVE else re.IGNORECASE
            out.setdefault(WORD.search(name)[0].lower(), []).append((canonical, re.compile(BEFORE + re.escape(name) + AFTER, case)))
    return out


def matcher(text: str | None = None):
    """Python function for use inside UDFs: text, or part of the given text -> set of canonical names. Only names whose
    first word is in the text are looked for."""
    rules = _compiled()
    some = None if text is None else {w: rules[w] for w in rules.keys() & set(WORD.findall(lowered(text)))}

    def find(part: str) -> set[str]:
        within = rules if some is None else some
        return {c for w in within.keys() & set(WORD.findall(lowered(part))) for c, p in within[w] if p.search(part)} if within else set()

    return find


def overlapping(names: list[str]) -> bool:
    """Whether a name may begin within another and end after it, so that finding one may hide the other."""
    return any(a.lower().endswith(b.lower()[:k]) for a in names for b in names for k in range(1, len(b)) if re.match(r"[^\w+#&]", b[k:]) and re.search(r"(?<![\w+#&.])$", a[: len(a) - k]) and k < len(a))


def keyword_skills(text: Column, vocabulary=None, exact=None) -> Column:
    """Sorted canonical names found in the text. One alternation, longest names first, goes through the whole text; the
    rules of the single names then see only what it found."""
    rules = patterns(vocabulary, exact)
    if not rules:
        return F.array().cast("array<string>")
    find = lambda t: F.array_compact(F.array(*(F.when(t.rlike(("(?U)" if case else "(?iU)") + p), F.lit(c)) for c, p, case in rules)))
    names = sorted({n for c, more in (vocabulary or fixed.SKILLS).items() for n in (c, *more)}, key=lambda n: (-len(n), n))
    if not overlapping(names):
        alternation = "(?iU)" + BEFORE + "(?:" + "|".join(map(re.escape, names)) + ")" + AFTER
        text = F.array_join(F.array_distinct(F.regexp_extract_all(text, F.lit(alternation), F.lit(0))), "\n")
    # The lambda names what was found, so that the alternation is in the plan once.
    return F.array_sort(F.array_distinct(F.coalesce(F.get(F.transform(F.array(text), find), F.lit(0)), F.array().cast("array<string>"))))


def canonicalise(names: Column, vocabulary=None) -> Column:
    """Names (any case, aliases) to canonical ones; unknown names go."""
    pairs = [(n.lower(), c) for c, more in (vocabulary or fixed.SKILLS).items() for n in (c, *more)]
    lookup = F.create_map(*(F.lit(x) for pair in pairs for x in pair))
    known = F.transform(F.coalesce(names, F.array().cast("array<string>")), lambda n: F.try_element_at(lookup, F.lower(F.trim(n))))
    return F.array_sort(F.array_distinct(F.array_compact(known)))


def is_tech_title(title: Column) -> Column:
    title = F.coalesce(title, F.lit(""))
    return title.rlike("(?iU)" + fixed.TECH_TITLE) | title.rlike("(?U)" + fixed.TECH_TITLE_EXACT)


def coverage(job: Column, own: Column, prior: int = fixed.COVERAGE_PRIOR) -> Column:
    return F.size(F.array_intersect(job, own)) / (F.size(job) + prior)


def matched(job: Column, own: Column) -> Column:
    return F.array_sort(F.array_intersect(job, own))


def missing(job: Column, own: Column) -> Column:
    return F.array_sort(F.array_except(job, own))
