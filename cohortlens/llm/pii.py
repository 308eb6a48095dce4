"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Column expressions only, one pass over the texts, no shuffle. The positions of a pattern's matches
come from the text between them: ``split`` gives the gaps, so a match starts after all earlier gaps
and matches. Patterns are written so that a failed start is never tried again inside the same run of
characters (look-behind, possessive repeats), which keeps long texts linear and off the stack; they
find the same matches as the plain patterns in ``KINDS``.

Kinds ``email, ip, card, phone`` are always reported. The method adds ``iban`` (mod-97), ``ssn``
(reported where nearby words lift its score to ``REPORTED``) and ``secret`` (a value with a digit given
to a name like token or password). An account number is followed by words that look like more groups of
it, so the longest part up to a space that passes mod-97 is the span; a second number directly behind
it, written in groups, may lie in the same match and is then not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sheltered, table, whole_text

#: Characters before a span in which context words count.
CONTEXT_CHARS = 40
#: Added kinds are reported from this score on.
REPORTED = 60
CONTEXT_GAIN, CONTEXT_LOSS = 25, 30
#: Matches of a text that are gathered before they are appended to its spans.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    name: str
    plain: str          # what is looked for, in the common subset of regular expressions
    fast: str           # the same matches in linear time with Java's expressions
    gate: str           # a text without this has no match
    score: int          # of a confirmed span without context, in percent
    near: str           # words that raise the score
    base: bool = True


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_NOT_IN_WORD, _WORD_ENDS = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
_IBAN = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
#: Letters and digits that the shortest account number has.
_IBAN_LEAST = 15
_SECRET = r"(?i:token|passwd|password|secret|api[_-]?key)[\"']? ?[:=] ?[\"']?[A-Za-z0-9_/+.-]{12,}"
_SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"

KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 70, "mail|contact|write|courriel|correo|kontakt"),
    Kind("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         "[0-9]", 60, "ip|host|server|address|login|adresse"),
    Kind("card", r"[0-9](?:[ -]?[0-9])+", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
         "[0-9]", 65, "card|visa|credit|payment|carte|karte|tarjeta"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]",
         r"\+", 60, "phone|call|tel|mobile|fax|contact"),
    Kind("iban", rf"\b{_IBAN}\b", f"{_NOT_IN_WORD}{_IBAN}{_WORD_ENDS}",
         "[0-9]", 75, "iban|bank|account|konto|compte|cuenta", False),
    Kind("ssn", rf"\b{_SSN}\b", f"{_NOT_IN_WORD}{_SSN}{_WORD_ENDS}",
         "[0-9]", 40, "ssn|social security", False),
    Kind("secret", _SECRET, _SECRET, "[:=]", 65, "login|user|auth|config|credential", False),
)
#: Words before a span that make personal data unlikely.
UNLIKELY = "version|release|isbn|invoice no|example"


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def term(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda total, i: total + term(i)) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number (letters and digits) leaves 1 when read as a number modulo 97."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _account(match: Column) -> Column:
    """Length of the longest part of ``match``, whole or up to a space, that is an account number."""
    parts = F.split(match, " ")
    part = lambda i, between: F.array_join(F.slice(parts, 1, i), between)
    passes = lambda i: _bound(part(i, ""), lambda code: (F.length(code) >= _IBAN_LEAST) & mod97(code))
    return F.length(part(F.array_max(F.filter(F.sequence(F.lit(1), F.size(parts)), passes)), " "))


def _kept(kind: str, match: Column) -> Column:
    """How much of a match is personal data: its length, NULL if it is not confirmed."""
    return _account(match) if kind == "iban" else F.when(_confirmed(kind, match), F.length(match))


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        return F.length(_digits(match)).between(14, 19) & luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "secret":
        return match.rlike("[:=][^0-9]*[0-9]")
    return F.lit(True)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(kind: Kind, order: int, matches: Column, gaps: Column) -> Column:
    """Array of (start, order, end, name, score) of the confirmed matches.

    Matches are taken in blocks: an array that grows by one is copied each time, so a block's own
    array is filled first and then appended, which keeps texts with very many matches from going quadratic.
    """
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,score:int>>")
    tail = lambda s: F.substring(s, F.greatest(F.length(s) - CONTEXT_CHARS + 1, F.lit(1)), F.lit(CONTEXT_CHARS))

    def scored(near: Column) -> Column:
        return (
            F.lit(kind.score)
            + F.when(near.rlike(rf"(?:^|[^a-z])(?:{kind.near})"), CONTEXT_GAIN).otherwise(0)
            - F.when(near.rlike(rf"(?:^|[^a-z])(?:{UNLIKELY})"), CONTEXT_LOSS).otherwise(0)
        )

    def step(acc: Column, i: Column) -> Column:
        here = F.struct(
            (acc["at"] + F.length(gaps[i])).alias("start"),
            (acc["at"] + F.length(gaps[i]) + F.length(matches[i])).alias("at"),
            tail(F.concat(acc["before"], gaps[i])).alias("near"),
            _kept(kind.name, matches[i]).alias("kept"),
        )

        def grown(x: Column) -> Column:
            span = F.struct(x["start"].alias("start"), F.lit(order).alias("order"), (x["start"] + x["kept"]).alias("end"), F.lit(kind.name).alias("kind"), scored(F.lower(x["near"])).alias("score"))
            return F.struct(
                x["at"].alias("at"), tail(F.concat(x["near"], matches[i])).alias("before"),
                F.when(x["kept"].isNotNull(), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
            )

        return _bound(here, grown)

    def block(acc: Column, first: Column) -> Column:
        last = F.least(first + BLOCK - 1, F.size(matches) - 1)
        start = F.struct(acc["at"].alias("at"), acc["before"].alias("before"), none.alias("spans"))
        return _bound(
            F.aggregate(F.sequence(first, last), start, step),
            lambda x: F.struct(x["at"].alias("at"), x["before"].alias("before"), F.concat(acc["spans"], x["spans"]).alias("spans")),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), none.alias("spans"))
    blocks = F.sequence(F.lit(0), F.size(matches) - 1, F.lit(BLOCK))
    found = F.when(F.size(matches) > 0, F.aggregate(blocks, start, block, lambda acc: acc["spans"])).otherwise(none)
    return found if kind.base else F.filter(found, lambda s: s["score"] >= REPORTED)


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``pii``: array of (start, order, end, kind, score) by start, then kind.

    Positions are code points, ends exclusive; scores are percent. Spans of different kinds may
    overlap. NULL and empty texts have an empty array; each row stands by itself, so repeated rows have
    equal arrays and an empty table has none. Texts of any length are searched whole. ``pii`` replaces a
    column of that name; all others stay as they are.
    """
    kept = [c for c in docs.columns if c != "pii" or c == text]
    docs, back = sheltered(docs.select(*[f"`{c}`" for c in kept]), text)
    df = docs.withColumn("_pii_text", whole_text(text))
    for kind in KINDS:
        possible = F.col("_pii_text").rlike(kind.gate)
        df = df.withColumn(f"_{kind.name}_found", F.when(possible, F.regexp_extract_all("_pii_text", F.lit(kind.fast), 0)).otherwise(F.array().cast("array<string>")))
    for kind in KINDS:
        gaps = F.when(F.size(f"_{kind.name}_found") > 0, F.split("_pii_text", kind.fast, -1))
        df = df.withColumn(f"_{kind.name}_gaps", gaps)
    for order, kind in enumerate(KINDS):
        df = df.withColumn(f"_{kind.name}_spans", _spans(kind, order, F.col(f"_{kind.name}_found"), F.col(f"_{kind.name}_gaps")))
    spans = F.array_sort(F.concat(*[f"_{k.name}_spans" for k in KINDS]))
    return df.select(*[b for c, b in zip(kept, back) if c != "pii"], spans.alias("pii"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii_native(spark, sf_dir):
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda name: F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    base = F.filter("pii", lambda s: s["order"] < sum(k.base for k in KINDS))
    return found.select(
        "doc_id",
        *[count(k.name) for k in KINDS if k.base],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
        *[count(k.name) for k in KINDS if not k.base],
        F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores"),
        (F.size("pii") > 0).alias("found"),
    )


def _oracle() -> str:
    checks = {
        "ip": rf"regexp_full_match(m, '(?:{_OCTET}\.){{3}}{_OCTET}')",
        "card": "len(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(0, len(d)), lambda j: CASE WHEN j % 2 = 0 THEN CAST(d[len(d) - j] AS INT) "
                "WHEN 2 * CAST(d[len(d) - j] AS INT) > 9 THEN 2 * CAST(d[len(d) - j] AS INT) - 9 ELSE 2 * CAST(d[len(d) - j] AS INT) END)) % 10 = 0",
        "phone": "len(d) BETWEEN 10 AND 15",
        "secret": "regexp_matches(m, '[:=][^0-9]*[0-9]')",
    }
    code = "array_to_string(string_split(m, ' ')[1:k], '')"
    account = (
        f"length({code}) >= {_IBAN_LEAST} AND list_reduce(list_transform(string_split(array_to_string(list_transform(string_split(substr({code}, 5) || substr({code}, 1, 4), ''), "
        "lambda c: CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), ''), ''), lambda c: CAST(c AS INT)), lambda a, b: (a * 10 + b) % 97) = 1"
    )
    accounts = f"list_max(list_transform(list_filter(range(1, len(string_split(m, ' ')) + 1), lambda k: {account}), lambda k: length(array_to_string(string_split(m, ' ')[1:k], ' '))))"
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    found = " UNION ALL ".join(
        f"SELECT doc_id, t, '{k.name}' AS kind, {i} AS ord, {k.score} AS score, {quoted('(?:^|[^a-z])(?:' + k.near + ')')} AS near_words, {k.base} AS base, "
        f"regexp_extract_all(t, {quoted(k.plain)}) AS ms, string_split_regex(t, {quoted(k.plain)}) AS gs FROM d"
        for i, k in enumerate(KINDS)
    )
    confirm = " ".join(f"WHEN kind = '{k}' AND NOT ({sql}) THEN NULL" for k, sql in checks.items())
    n = sum(k.base for k in KINDS)
    counted = lambda base: ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base == base)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
each AS (SELECT doc_id, t, kind, ord, score, near_words, base, ms, gs, ms[i] AS m, regexp_replace(ms[i], '[^0-9]', '', 'g') AS d, i
         FROM found, range(1, len(ms) + 1) AS r(i)),
placed AS (SELECT *, CAST(list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
                  CASE {confirm} WHEN kind = 'iban' THEN {accounts} ELSE length(m) END AS kept
           FROM each),
near AS (SELECT *, s + kept AS e, lower(substr(t, greatest(s - {CONTEXT_CHARS}, 0) + 1, least(s, {CONTEXT_CHARS}))) AS w FROM placed WHERE kept IS NOT NULL),
scored AS (SELECT *, score + CASE WHEN regexp_matches(w, near_words) THEN {CONTEXT_GAIN} ELSE 0 END
                   - CASE WHEN regexp_matches(w, '(?:^|[^a-z])(?:{UNLIKELY})') THEN {CONTEXT_LOSS} ELSE 0 END AS sc FROM near),
spans AS (SELECT doc_id, kind, ord, s, e, sc, kind || ':' || s || ':' || e AS span FROM scored WHERE base OR sc >= {REPORTED}),
joined AS (SELECT doc_id, {counted(True)}, {counted(False)},
                  string_agg(span, ',' ORDER BY s, ord, e) FILTER (ord < {n}) AS base, string_agg(span, ',' ORDER BY s, ord, e) AS spans,
                  string_agg(CAST(sc AS VARCHAR), ',' ORDER BY s, ord, e) AS scores
           FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in KINDS)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores, spans IS NOT NULL AS found
FROM d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""


ORACLE = _oracle()
