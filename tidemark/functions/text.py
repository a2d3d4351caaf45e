"""Text functions: identifiers, tags, tokens, HTML, Markdown sections and figures, all as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CHARS_PER_TOKEN = 2.6

# Elements that end a line, elements that vanish without a space, and the entities decoded by name.
BLOCK_TAGS = "address article aside blockquote br caption dd div dl dt figcaption footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead title tr ul".split()
INLINE_TAGS = "a abbr b big em font i ins del s small span strike strong sub sup tt u".split()
ENTITIES = {"nbsp": "\u00a0", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "mdash": "—", "ndash": "–", "rsquo": "’", "lsquo": "‘", "rdquo": "”", "ldquo": "“", "hellip": "…", "bull": "•", "middot": "·", "copy": "©", "reg": "®", "trade": "™", "sect": "§", "para": "¶", "deg": "°", "plusmn": "±", "times": "×", "divide": "÷", "minus": "−", "frac12": "½", "euro": "€", "pound": "£", "yen": "¥", "cent": "¢", "dagger": "†", "eacute": "é", "egrave": "è", "uuml": "ü", "ouml": "ö", "auml": "ä", "szlig": "ß", "ntilde": "ñ", "ccedil": "ç", "amp": "&"}

# Spellings of units and their scale, and words before a number that make it a reference or a day.
UNITS = {"percent": "%", "points": "pt", "point": "pt", "pp": "pt", "bps": "bp", "bp": "bp", "×": "x", "million": "M", "m": "M", "billion": "B", "bn": "B", "b": "B", "thousand": "K", "k": "K"}
SCALES = {"K": 1e-3, "M": 1.0, "B": 1e3}
REFERENCES = "item items note notes part parts exhibit exhibits page pages section figure table chapter".split()
MONTHS = "january february march april may june july august september october november december jan feb mar apr jun jul aug sep sept oct nov dec".split()

# The shape of a word that is a quantity: a sign, a currency, digits, a unit. What else holds digits (dates, identifiers,
# forms, ordinals, "30-day") has another shape and is none.
DIGITS = r"(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:[.][0-9]+)?"
ATTACHED = r"(?:%|[xX×]|bps?|pp|pts?|bn|[MBKmbk])"
BEFORE, BEHIND = "[\\[\"“‘']+", "[\\].,;:!?\"”’']+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_cik(value: Column | str) -> Column:
    """Ten digits with leading zeros, with or without a CIK prefix; null for anything else."""
    digits = F.regexp_replace(F.upper(F.trim(_col(value).cast("string"))), "^CIK", "")
    return F.when(digits.rlike("^[0-9]{1,10}$"), F.lpad(digits, 10, "0"))


def normalize_accession(value: Column | str) -> Column:
    """18 digits as 10-2-6 with hyphens; null for anything else."""
    digits = F.regexp_replace(F.trim(_col(value)), "-", "")
    return F.when(digits.rlike("^[0-9]{18}$"), F.concat_ws("-", F.substring(digits, 1, 10), F.substring(digits, 11, 2), F.substring(digits, 13, 6)))


def form_key(form: Column | str) -> Column:
    """The comparison key of a form: upper case, letters and digits only; SCHEDULE is SC, FORM3 is 3."""
    key = F.regexp_replace(F.upper(_col(form)), "[^A-Z0-9]", "")
    return F.regexp_replace(F.regexp_replace(key, "^SCHEDULE", "SC"), "^FORM([0-9]+)$", "$1")


def parse_tag(tag: Column | str) -> Column:
    """ticker-form-rest as struct(ticker, form, period, date, ordinal); the rest is a period or a filing date with an ordinal."""
    t = _col(tag)
    pattern = "^([A-Z0-9][A-Z0-9.]*)-([A-Z0-9]+)-(.+)$"
    rest = F.regexp_extract(t, pattern, 3)
    dated = "^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:-([0-9]+))?$"
    day = F.regexp_extract(rest, dated, 1).try_cast("date")
    n = F.regexp_extract(rest, dated, 2).try_cast("int")
    bad = rest.rlike(dated) & day.isNull()
    return F.when(
        t.rlike(pattern) & ~bad,
        F.struct(
            F.regexp_extract(t, pattern, 1).alias("ticker"),
            F.regexp_extract(t, pattern, 2).alias("form"),
            F.when(rest.rlike("^FY[0-9]{4}(Q[1-4])?$"), rest).alias("period"),
            day.alias("date"),
            F.coalesce(n, F.lit(1)).alias("ordinal"),
        ),
    )


def estimate_tokens(text: Column | str) -> Column:
    """ASCII characters divided by 2.6, rounded down, and one for every other code point."""
    t = _col(text)
    other = F.length(F.regexp_replace(t, r"[\x00-\x7F]", ""))
    return (F.floor((F.length(t) - other) / F.lit(CHARS_PER_TOKEN)) + other).cast("long")


def collapse(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(text), r"[ \t\n\x0B\f\r]+", " "))


def unescape(text: Column | str) -> Column:
    """Character references decoded: the named ones of ENTITIES, decimal and hexadecimal ones. Unknown ones stay; what a
    decoded ampersand begins isn't decoded again."""
    parts = F.split(_col(text), "&")
    named = F.create_map(*(F.lit(x) for kv in ENTITIES.items() for x in kv))

    def part(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, "^([A-Za-z][A-Za-z0-9]*|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});", 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(F.startswith(name, F.lit("#")), F.substr(name, F.lit(2))).try_cast("int")
        sign = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise(F.element_at(named, F.when(name != "", name)))
        rest = F.substr(p, F.length(name) + 2)
        return F.when(i == 0, p).when(sign.isNotNull(), F.concat(sign, rest)).otherwise(F.concat(F.lit("&"), p))

    return F.array_join(F.transform(parts, part), "")


def html_to_text(html: Column | str) -> Column:
    """Visible text, one line a block: head, scripts, styles and inline metadata headers go, inline tags leave no space,
    character references are decoded."""
    squeezed = lambda c: F.regexp_replace(c, r"[ \t\n\x0B\f\r\xA0]+", " ")
    body = squeezed(F.regexp_replace(_col(html), r"(?is)<(script|style|head|ix:header)\b.*?</\1[ \t\r\n]*>", " "))
    # One split at tags: a piece begins with the rest of its tag, whose name says what the tag leaves.
    name = lambda p: F.lower(F.regexp_extract(p, "^/?([A-Za-z][A-Za-z0-9:]*)[^>]*>", 1))
    left = lambda p: F.when(name(p).isin(*BLOCK_TAGS), "\n").when(name(p).isin(*INLINE_TAGS), "").otherwise(" ")
    pieces = F.transform(F.split(body, "<"), lambda p, i: F.when((i == 0) | ~p.contains(">"), F.when(i == 0, p).otherwise(F.concat(F.lit("<"), p))).otherwise(F.concat(left(p), F.substr(p, F.instr(p, F.lit(">")) + 1))))
    lines = F.transform(F.split(unescape(F.array_join(pieces, "")), "\n"), lambda x: F.trim(squeezed(x)))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def redact(text: Column | str, secrets: list[str]) -> Column:
    """Every secret masked, longest first, so that one inside another leaves nothing behind."""
    t = _col(text)
    for s in sorted({x for x in secrets if x}, key=lambda x: (-len(x), x)):
        t = F.replace(t, F.lit(s), F.lit("***"))
    return t


def parse_money(text: Column | str) -> Column:
    """$1,304.00 as a number; null where it isn't one."""
    return F.regexp_replace(_col(text), r"[$, ]", "").try_cast("double")


def parse_number(text: Column | str) -> Column:
    """Numbers as people write them: thousands separators, a dollar or percent sign, a minus or parentheses for negatives."""
    t = F.trim(_col(text))
    plain = F.regexp_replace(t, r"[$,%() ]", "")
    value = F.regexp_replace(plain, "−", "-").try_cast("double")
    return F.when(t.rlike(r"^\(.*\)$"), -value).otherwise(value)


def figures(text: Column | str) -> Column:
    """The quantities in a text, in order: array of struct(text, value, unit, decimals).

    Words are judged by their shape and by their neighbours: a quantity stands alone in its word, but for a sign, a
    dollar sign, accounting parentheses (which make it negative, as a minus does) and a unit, attached or the next word. It
    is none behind a word of reference ("Item 7") or a month's name, nor is a bare year. Source tags in brackets are no text.
    """
    words = F.filter(F.split(F.regexp_replace(_col(text), r"\[src:[^\]]*\]", " "), "[ \t\r\n]+"), lambda w: w != "")
    strip = lambda w: F.regexp_replace(F.regexp_replace(w, f"^{BEFORE}", ""), f"{BEHIND}$", "")
    account = rf"^[$]?[(][$]?{DIGITS}[)]{ATTACHED}?$"
    plain = rf"^[(]?[−-]?[$]?{DIGITS}{ATTACHED}?[)]?$"
    named = F.create_map(*(F.lit(x) for kv in UNITS.items() for x in kv))

    # Each step is an array of its own, so that no expression runs twice; the words are bound once by a lambda.
    def shaped(ws: Column) -> Column:
        near = lambda i: F.coalesce(F.get(ws, i), F.lit(""))
        return F.array_compact(F.transform(ws, lambda w, i: F.when(w.rlike("[0-9]"), F.struct(strip(w).alias("core"), w.alias("w"), near(i - 1).alias("before"), near(i + 1).alias("after")))))

    found = F.filter(F.get(F.transform(F.array(words), shaped), F.lit(0)), lambda x: x["core"].rlike(plain) | x["core"].rlike(account))

    def parts(x: Column) -> Column:
        core = x["core"]
        return F.struct(
            core.alias("text"), core.contains("$").alias("money"), core.rlike(account).alias("account"), F.regexp_extract(core, f"({DIGITS})", 1).alias("number"),
            F.lower(F.regexp_extract(core, f"[0-9][)]?({ATTACHED})[)]?$", 1)).alias("own"), F.lower(F.regexp_replace(strip(x["before"]), "[.(]", "")).alias("lead"),
            F.when(x["w"].rlike("[0-9)]$"), F.lower(F.regexp_replace(strip(x["after"]), "[)]+$", ""))).alias("next"),
        )

    def quantity(x: Column) -> Column:
        spelled = F.when(x["own"] != "", x["own"]).when(x["next"].isin(*[u for u in UNITS if len(u) > 1]), x["next"]).otherwise("")
        decimals = F.when(x["number"].contains("."), F.length(F.substring_index(x["number"], ".", -1))).otherwise(0)
        return F.struct(x["text"].alias("text"), x["money"].alias("money"), x["account"].alias("account"), x["number"].alias("number"), x["lead"].alias("lead"), F.coalesce(F.element_at(named, spelled), spelled).alias("unit"), decimals.alias("decimals"))

    def kept(x: Column) -> Column:
        bare = x["unit"] == ""
        year = bare & ~x["money"] & ~x["account"] & x["number"].rlike("^(?:19|20)[0-9]{2}$")
        day = bare & x["lead"].isin(*MONTHS) & x["number"].rlike("^[0-9]{1,2}$")
        return ~year & ~day & ~(bare & x["lead"].isin(*REFERENCES))

    def shown(x: Column) -> Column:
        value = F.regexp_replace(x["number"], ",", "").try_cast("double")
        minus = x["account"] | x["text"].rlike("^[(]?[−-]")
        return F.struct(x["text"].alias("text"), F.when(minus, -value).otherwise(value).alias("value"), x["unit"].alias("unit"), x["decimals"].alias("decimals"))

    return F.transform(F.filter(F.transform(F.transform(found, parts), quantity), kept), shown)


def distinctive(figure_text: Column | str) -> Column:
    """Three significant digits or more, or two and a decimal point."""
    t = _col(figure_text)
    digits = F.length(F.regexp_replace(F.regexp_replace(t, "[^0-9]", ""), "^0+", ""))
    return (digits >= 3) | (t.contains(".") & (digits >= 2))


def same_number(a: Column, b: Column, decimals: Column) -> Column:
    """Equal to the last of so many decimals, signs apart."""
    return F.abs(F.abs(a) - F.abs(b)) <= F.lit(0.5) * F.pow(F.lit(10.0), -decimals) + 1e-9


def in_millions(value: Column, unit: Column) -> Column:
    scale = F.create_map(*(F.lit(x) for kv in SCALES.items() for x in kv))
    return value * F.coalesce(F.element_at(scale, unit), F.lit(1.0))


def front_matter(text: Column | str) -> Column:
    """struct(front, body): what stands between two lines of --- at the very top, and the rest."""
    t = _col(text)
    pattern = r"(?s)\A---[ \t]*\n(.*?)\n---[ \t]*(?:\n|\z)(.*)\z"
    return F.when(t.rlike(pattern), F.struct(F.regexp_extract(t, pattern, 1).alias("front"), F.regexp_extract(t, pattern, 2).alias("body"))).otherwise(F.struct(F.lit(None).cast("string").alias("front"), t.alias("body")))


def headings(text: Column | str, level: int) -> Column:
    """Markdown sections of a level: array of struct(title, body), text above the first heading under an empty title.
    What looks like a heading between lines of ``` is text."""
    numbered = F.transform(F.split(_col(text), "\n"), lambda x: F.struct(x.alias("x"), x.rlike("^ {0,3}```").alias("fence")))
    mark = "#" * level + " "
    empty = "array<struct<title:string,lines:array<string>>>"
    start = F.struct(F.lit(False).alias("inside"), F.array(F.struct(F.lit("").alias("title"), F.array().cast("array<string>").alias("lines"))).cast(empty).alias("done"))

    def step(at, line):
        opens = ~at["inside"] & ~line["fence"] & F.startswith(line["x"], F.lit(mark))
        last = F.element_at(at["done"], -1)
        grown = F.struct(last["title"].alias("title"), F.array_append(last["lines"], line["x"]).alias("lines"))
        more = F.array_append(F.slice(at["done"], F.lit(1), F.size(at["done"]) - 1), grown)
        fresh = F.array_append(at["done"], F.struct(F.trim(F.substr(line["x"], F.lit(level + 2))).alias("title"), F.array().cast("array<string>").alias("lines")))
        return F.struct((at["inside"] != line["fence"]).alias("inside"), F.when(opens, fresh).otherwise(more).cast(empty).alias("done"))

    found = F.aggregate(numbered, start, step)["done"]
    return F.transform(found, lambda s: F.struct(s["title"].alias("title"), F.array_join(s["lines"], "\n").alias("body")))


def content_hash(text: Column | str) -> Column:
    """Hex SHA-256 of UTF-8 text with line ends as \\n and no white space at line ends or the end."""
    t = F.regexp_replace(F.regexp_replace(_col(text), "\r\n?", "\n"), "[ \t]+(?=\n|$)", "")
    return F.sha2(F.rtrim(F.regexp_replace(t, "\n+$", "")), 256)


def canonical_json(text: Column | str) -> Column:
    """JSON text with keys in order at every depth, without blanks; null where it isn't JSON or an object names a key twice.
    What follows a whole value isn't looked at. A VARIANT keeps the fields of its objects by name, so this is what it prints."""
    return F.to_json(F.try_parse_json(_col(text)))


def json_hash(text: Column | str) -> Column:
    """Hex SHA-256 of canonical JSON: equal for texts that differ in blanks and in the order of keys only."""
    return F.sha2(canonical_json(text), 256)


def stems(text: Column | str, stop_words: list[str]) -> Column:
    """Distinct words of four letters or more, lower-cased, without stop words, cut to seven letters with the plural off."""
    words = F.regexp_extract_all(F.lower(_col(text)), F.lit("([a-z]{4,})"), F.lit(1))
    kept = F.filter(words, lambda w: ~w.isin(stop_words) if stop_words else F.lit(True))
    return F.array_distinct(F.transform(kept, lambda w: F.substring(F.regexp_replace(w, "(?<=[a-z]{3})s$", ""), 1, 7)))


def sentences(text: Column | str) -> Column:
    """A text split after . ; ! or ? where white space and a capital, quote, bracket or sign follow."""
    return F.filter(F.split(_col(text), r'(?<=[.;!?])[ \t\r\n]+(?=[A-Z("“$−-])'), lambda s: F.trim(s) != "")
