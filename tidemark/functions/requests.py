"""Requests for documents in free text: clauses, and what each asks for, by a table of rules over signals.

A clause is reduced to its signals (tokens that name a form, phrases, and what its numbers say); a rule is a row that needs some
signals, lacks others and names a kind of document. All rules are matched by set operations on arrays, so other vocabularies
and other rules are other rows. Items, exhibits, sections and periods that a clause names go with the kinds that can have them.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import once
from .text import _col


class Rule(NamedTuple):
    kind: str
    needs: tuple[str, ...]
    lacks: tuple[str, ...] = ()
    items: str = "none"  # none, all, results or others: the items that go with the request


#: Names of forms, as tokens of a clause in capitals, with what they signal.
TOKENS = {
    "10-Q": "quarter", "10-QS": "quarter", "10-K": "year", "10-KS": "year", "20-F": "year", "20-FS": "year", "40-F": "year", "40-FS": "year",
    "8-K": "current", "8-KS": "current", "6-K": "foreign", "6-KS": "foreign", "DEF14A": "proxy", "14A": "proxy", "13D": "stake", "13G": "stake", "S-4": "deal", "F-4": "deal", "DEFM14A": "deal",
}
#: Phrases, as words in lower case and the singular, side by side.
PHRASES = {
    "results": ["result", "earning", "quarterly figure"],
    "news": ["press release", "announcement", "news release"],
    "spoken": ["transcript", "webcast", "conference call", "earning call", "call recording", "investor day"],
    "outsider": ["regulator", "ministry", "court", "newspaper", "analyst", "broker", "index provider", "trade association", "statistics office", "rating agency", "competitor"],
    "proxy": ["proxy statement"],
    "deal": ["merger proxy", "merger prospectus"],
    "insider": ["form 3", "form 4", "form 5", "insider trade"],
    "business": ["business section", "description of the business"],
    "risk_factors": ["risk factor"],
    "mdna": ["md&a", "management discussion"],
    "financials": ["financial statement", "note"],
}
SECTIONS = ["business", "risk_factors", "mdna", "financials"]
RULES = [
    Rule("release", ("current", "item of results"), items="results"),
    Rule("release", ("current", "results"), ("numbered",), items="results"),
    Rule("current", ("current", "other items"), items="others"),
    Rule("current", ("current",), ("numbered", "results")),
    Rule("release", ("foreign", "results")),
    Rule("release", ("foreign", "exhibited"), ("results",)),
    Rule("current", ("foreign",), ("results", "exhibited")),
    Rule("quarterly", ("quarter",)),
    Rule("annual", ("year",)),
    Rule("proxy", ("proxy",), ("deal",)),
    Rule("ownership", ("insider",)),
    Rule("beneficial", ("stake",)),
    Rule("merger", ("deal",)),
    Rule("release", ("news", "results"), ("current", "foreign", "outsider", "stranger", "files abroad"), items="results"),
    Rule("release", ("news", "results", "files abroad"), ("current", "foreign", "outsider", "stranger")),
    Rule("press", ("news",), ("results", "current", "foreign", "outsider", "stranger")),
]
WITH_SECTIONS = {"quarterly", "annual"}
WITH_EXHIBITS = {"release", "current"}
RESULTS_ITEM = "2.02"
QUARTERS = {"first": 1, "second": 2, "third": 3, "fourth": 4}
ARTICLES = ["The", "This", "That", "Its", "Their", "Each", "Any", "Both"]


def clauses(text: Column | str) -> Column:
    """A text cut at semicolons, and at full stops before a capital, that stand outside brackets; blanks and commas at the
    ends of a clause go. Cutting first and joining what a bracket holds together needs no look at single characters."""
    t = F.trim(F.regexp_replace(_col(text), "[ \t\n\r]+", " "))
    pieces = F.split(F.regexp_replace(t, r"(?<=[a-z0-9)\]A-Z])[.] (?=[A-Z])", ".\u0001"), "(?<=;)|\u0001")
    depth = lambda s: F.length(F.regexp_replace(s, r"[^(\[]", "")) - F.length(F.regexp_replace(s, r"[^)\]]", ""))
    start = F.struct(F.lit(0).alias("open"), F.array().cast("array<string>").alias("done"))

    def step(at, piece):
        last = F.element_at(at["done"], -1)
        joined = F.array_append(F.slice(at["done"], F.lit(1), F.size(at["done"]) - 1), F.concat(last, F.when(F.startswith(piece, F.lit(" ")), "").otherwise(" "), piece))
        return F.struct(F.greatest(at["open"] + depth(piece), F.lit(0)).alias("open"), F.when(at["open"] > 0, joined).otherwise(F.array_append(at["done"], piece)).alias("done"))

    found = F.aggregate(pieces, start, step)["done"]
    return F.filter(F.transform(found, lambda c: F.regexp_replace(c, "^[ ,.;]+|[ ,.;]+$", "")), lambda c: c != "")


def numbers_after(clause: Column, word: str, shape: str) -> Column:
    """Numbers of a shape that follow a word: "Items 2.02 and 9.01"."""
    lists = F.regexp_extract_all(clause, F.lit(rf"(?i)\b{word}s? ({shape}(?:(?:, | and | & ){shape})*)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(lists, lambda x: F.regexp_extract_all(x, F.lit(f"({shape})"), F.lit(1))))))


def periods(clause: Column | str) -> Column:
    """The fiscal periods that a clause names, as 2025 or 2025Q3, in order and once each: FY2025, FY2025Q3, fiscal 2024, Q3 2025,
    2025Q3, third quarter of 2025, and spans of years (FY2021-2023, at most twenty)."""
    c = F.regexp_replace(_col(clause), "[–—]", "-")
    for word, n in QUARTERS.items():
        c = F.regexp_replace(c, rf"(?i)\b{word} quarter(?: of)?(?: fiscal)?(?: year)? ((?:19|20)[0-9]{{2}})\b", f"$1Q{n}")
    c = F.regexp_replace(c, r"(?i)\bQ([1-4])(?: of)?(?: fiscal)? ?(?:FY)?((?:19|20)[0-9]{2})\b", "$2Q$1")
    marks = F.regexp_extract_all(c, F.lit(r"(?i)(?:\b(?:FY|fiscal(?: years?)?) ?)((?:19|20)[0-9]{2}(?:Q[1-4]|(?:-| to | through )(?:FY)?(?:19|20)[0-9]{2})?)\b|\b((?:19|20)[0-9]{2}Q[1-4])\b"), F.lit(0))
    bare = F.transform(marks, lambda m: F.regexp_replace(F.upper(m), "[^0-9Q-]|TO|THROUGH", " "))
    parts = F.transform(bare, lambda m: F.regexp_extract_all(m, F.lit("((?:19|20)[0-9]{2}(?:Q[1-4])?)"), F.lit(1)))

    def spread(p: Column) -> Column:
        first, last = F.get(p, F.lit(0)).try_cast("int"), F.get(p, F.lit(1)).try_cast("int")
        years = F.sequence(first, F.greatest(first, F.least(last, first + 19)))
        return F.when(first.isNotNull() & last.isNotNull(), F.transform(years, lambda y: y.cast("string"))).otherwise(p)

    return F.array_distinct(F.flatten(F.transform(parts, spread)))


def strangers(clause: Column, owners: Column) -> Column:
    """Names with a possessive that aren't the company's own: capitalised words of which none is a word of one of its names."""
    names = F.regexp_extract_all(clause, F.lit(r"((?:[A-Z][\w&.-]*\s)*[A-Z][\w&.-]*)['’]s\b"), F.lit(1))
    words = lambda x: F.filter(F.split(F.lower(x), r"[^\w&]+"), lambda w: F.length(w) > 1)
    own = F.flatten(F.transform(owners, words))
    named = F.filter(F.array_distinct(names), lambda n: ~n.isin(*ARTICLES))
    return F.filter(named, lambda n: ~F.arrays_overlap(words(n), own))


def signals(clause: Column | str, foreign: Column, owners: Column) -> Column:
    """What a clause signals, as an array of names."""
    c = _col(clause)
    return _signals(c, foreign, owners, _items(c), _exhibits(c))


def _signals(c: Column, foreign: Column, owners: Column, items: Column, exhibits: Column) -> Column:
    tokens = F.split(F.upper(c), r"[^A-Z0-9-]+")
    forms = F.create_map(*(F.lit(x) for kv in TOKENS.items() for x in kv))
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.regexp_replace(c, "’", "'")), r"[^a-z0-9&'.-]+", " "), F.lit(" "))
    plain = F.regexp_replace(spaced, r"(?:[.]|'s|(?<=[^s&])s|')+(?= )", "")  # without full stops, possessives and plurals
    held = lambda text: F.array(*(F.when(reduce(Column.__or__, (text.contains(f" {p} ") for p in phrases)), F.lit(name)) for name, phrases in PHRASES.items()))
    said = once(plain, held)
    told = {"numbered": F.size(items) > 0, "item of results": F.array_contains(items, RESULTS_ITEM), "other items": F.size(F.array_remove(items, RESULTS_ITEM)) > 0, "exhibited": F.size(exhibits) > 0, "stranger": F.size(strangers(c, owners)) > 0, "files abroad": foreign}
    return F.array_distinct(F.array_compact(F.concat(F.transform(tokens, lambda t: F.element_at(forms, F.when(t != "", t))), said, F.array(*(F.when(cond, F.lit(name)) for name, cond in told.items())))))


def _items(c: Column) -> Column:
    return numbers_after(c, "Item", "[0-9]{1,2}[.][0-9]{2}")


def _exhibits(c: Column) -> Column:
    return F.transform(numbers_after(c, "Exhibit", "99[.][0-9]{1,2}"), lambda n: F.concat(F.lit("EX-"), n))


def requests(clause: Column | str, foreign: Column, owners: Column, rules: list[Rule] = RULES) -> Column:
    """struct(requests, notes) of a clause: array of struct(kind, items, exhibits, sections, periods), and why something isn't
    supplied. foreign: whether the company files abroad, so that its releases have no items."""
    none = F.array().cast("array<string>")

    def row(rule: Rule, s: Column, c: Column, items: Column, exhibits: Column) -> Column:
        """The rule's name and what goes with it; what the clause's periods are is added to the rules that hold."""
        needs, lacks = (F.array(*map(F.lit, x)).cast("array<string>") for x in (rule.needs, rule.lacks))
        match = (F.size(F.array_except(needs, s)) == 0) & ~F.arrays_overlap(lacks, s)
        picks = {"none": none, "all": items, "results": F.array(F.lit(RESULTS_ITEM)), "others": F.array_remove(items, RESULTS_ITEM)}
        sections = F.array_intersect(F.array(*map(F.lit, SECTIONS)), s) if rule.kind in WITH_SECTIONS else none
        return F.when(match, F.struct(F.lit(rule.kind).alias("kind"), picks[rule.items].alias("items"), (exhibits if rule.kind in WITH_EXHIBITS else none).alias("exhibits"), sections.alias("sections")))

    def judged(s: Column, c: Column, items: Column, exhibits: Column) -> Column:
        found = F.array_compact(F.array(*(row(rule, s, c, items, exhibits) for rule in rules)))
        dated = lambda found: F.when(F.size(found) > 0, once(periods(c), lambda when: F.transform(found, lambda r: F.struct(r["kind"].alias("kind"), r["items"].alias("items"), r["exhibits"].alias("exhibits"), r["sections"].alias("sections"), when.alias("periods")))))
        asked = F.array_distinct(once(found, lambda x: F.coalesce(dated(x), F.transform(x, lambda r: F.struct(r["kind"].alias("kind"), r["items"].alias("items"), r["exhibits"].alias("exhibits"), r["sections"].alias("sections"), none.alias("periods"))))))
        other = F.arrays_overlap(s, F.array(F.lit("outsider"), F.lit("stranger")))
        why = lambda asked: F.when(F.array_contains(s, "spoken"), "spoken, not filed").when(F.size(asked) == 0, "no filing of the company").when(other, "names documents of others too")
        return once(asked, lambda asked: F.struct(asked.alias("requests"), F.array_compact(F.array(F.concat(c, F.lit(": "), why(asked)))).alias("notes")))

    parts = lambda c: F.struct(c.alias("c"), _items(c).alias("items"), _exhibits(c).alias("exhibits"))
    signalled = lambda p: once(_signals(p["c"], foreign, owners, p["items"], p["exhibits"]), lambda s: judged(s, p["c"], p["items"], p["exhibits"]))
    return once(once(_col(clause), parts), signalled)
