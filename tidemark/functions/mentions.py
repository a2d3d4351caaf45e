"""The numbers of a text and what they are there for: a scan over its words with a small state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import once
from .text import MONTHS, REFERENCES, UNITS, _col

CONNECTORS = ["and", "or", "to", "through", "&", "-", "–"]
NUMBER = r"^[−+-]?[$]?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:[.][0-9]+)?%?$"
OPENING, CLOSING = "^[\\[\"“‘'(]+", "[\\]).,;:!?\"”’']+$"
FOUND = "array<struct<form:string,kind:string,unit:string>>"


def mentions(text: Column | str, references: list[str] = REFERENCES, months: list[str] = MONTHS, units: list[str] | None = None) -> Column:
    """Numbers in order as array of struct(form, kind, unit): reference ("Items 2, 3 and 4", all of them; three digits at most), day (before or behind a
    month), year (bare), note (a mark in brackets of one or two digits) or value, with its unit if that is the next word.

    A word of reference holds for all numbers behind it that only numbers and connectors separate from it, a month for the one
    next to it. Words are taken without quotes, brackets and full stops around them.
    """
    named = units if units is not None else [u for u in UNITS if len(u) > 1]
    words = F.filter(F.split(_col(text), "[ \t\r\n]+"), lambda w: w != "")

    def token(w: Column) -> Column:
        core = F.regexp_replace(F.regexp_replace(w, OPENING, ""), CLOSING, "")
        return once(core, lambda core: once(F.lower(core), lambda low: told(w, core, low)))

    def told(w: Column, core: Column, low: Column) -> Column:
        return F.struct(core.alias("core"), F.when(core.rlike(NUMBER), F.when(w.rlike(r"^[(\[][0-9]{1,2}[)\]]"), "note").otherwise("number")).when(low.isin(*months), "month").when(low.isin(*references), "reference").when(low.isin(*CONNECTORS) | (core == ""), "connector").when(low.isin(*named), "unit").otherwise("word").alias("is"), low.alias("low"))

    start = F.struct(F.lit("").alias("run"), F.lit(False).alias("fresh"), F.array().cast(FOUND).alias("out"))

    def step(s: Column, t: Column) -> Column:
        is_ = lambda name: t["is"] == name
        day = t["core"].rlike("^[0-9]{1,2}$")
        kind = F.when(is_("note"), "note").when((s["run"] == "reference") & t["core"].rlike("^[0-9]{1,3}$"), "reference").when((s["run"] == "month") & day, "day").when(t["core"].rlike("^(?:19|20)[0-9]{2}$"), "year").otherwise("value")
        grown = F.array_append(s["out"], F.struct(t["core"].alias("form"), kind.alias("kind"), F.lit(None).cast("string").alias("unit")))
        last = F.try_element_at(s["out"], F.lit(-1))
        changed = lambda k, u: F.concat(F.slice(s["out"], F.lit(1), F.size(s["out"]) - 1), F.array(F.struct(last["form"].alias("form"), k.alias("kind"), u.alias("unit")))).cast(FOUND)
        number = is_("number") | is_("note")
        late = is_("month") & s["fresh"] & (last["kind"] == "value") & last["form"].rlike("^[0-9]{1,2}$")
        out = F.when(number, grown.cast(FOUND)).when(late, changed(F.lit("day"), last["unit"])).when(is_("unit") & s["fresh"] & (last["kind"] == "value"), changed(last["kind"], t["low"])).otherwise(s["out"])
        run = F.when(is_("month"), F.when(late, "").otherwise("month")).when(is_("reference"), "reference").when(is_("connector"), F.when(s["run"] == "reference", "reference").otherwise("")).when(number & (s["run"] == "reference"), "reference").otherwise("")
        return F.struct(run.alias("run"), number.alias("fresh"), out.alias("out"))

    return F.aggregate(F.transform(words, token), start, step)["out"]
