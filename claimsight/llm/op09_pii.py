"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Only DataFrame functions run here.  A pattern's matches and the gaps between
them come from the same left-to-right search (``regexp_extract_all`` and
``split``), so running sums of their lengths give code point positions without
a UDF.  Patterns use possessive repeats and start either where the last match
ended or where a run of their characters begins; that takes the same matches
as the plain patterns in time linear in the text and without recursion, also
on texts that are one long run.

Every finding has a score: the kind's prior, raised by a valid checksum and by
a context word within ``CONTEXT_CHARS`` before or after.  The four base kinds
are kept whatever their score; the method's own kinds (``iban`` by mod-97,
``tel`` for numbers without a country code) need ``threshold``, which a ``tel``
only reaches beside a context word.

Results: null and empty texts have no findings (counts 0, the digest of the
empty string); repeated rows each get their own; an empty table gives an empty
result; other columns, of whatever name, are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
THRESHOLD = 0.6

# The contract's four patterns, stated for a search in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The method's own patterns.
IBAN = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
#: where one may start: a match that turns out too long must not hide the next
IBAN_START, IBAN_CHARS = r"[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]{4}){2})", 43
TEL = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    sign: str          # a cheap test that every text with a match passes
    prior: float
    context: str
    base: bool = True


KINDS = (
    Kind("email", EMAIL, r"@", 0.9, "mail|contact|write to|kontakt|correo|courriel"),
    Kind("ip", IP, r"[0-9]\.[0-9]", 0.5, "ip|address|host|server|client|login"),
    Kind("card", CARD, r"[0-9][\x20-]?[0-9]", 0.4, "card|visa|master|amex|credit|payment|karte|carte|tarjeta"),
    Kind("phone", PHONE, r"\+[0-9]", 0.6, "phone|tel|call|mobile|fax|whatsapp"),
    Kind("iban", IBAN, r"[A-Z]{2}[0-9]{2}", 0.3, "iban|account|bank|konto|compte|cuenta", base=False),
    Kind("tel", TEL, r"[0-9][\x20.-][0-9]", 0.4, "phone|tel|call|mobile|fax|whatsapp", base=False),
)
#: what a valid checksum and a context word add
CHECKSUM_GAIN, CONTEXT_GAIN = 0.4, 0.25


def positions(text: Column, pattern: str, sign: str) -> Column:
    """array<struct<start, end, value>>: code point spans of the pattern's matches."""
    found = F.when(text.rlike(sign), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    gaps = F.when(text.rlike(sign), F.split(text, pattern, -1))
    both = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                      lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.coalesce(F.aggregate(
        both, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + F.length(x["value"])).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"),
                                                  (acc["at"] + x["gap"] + F.length(x["value"])).alias("end"),
                                                  x["value"].alias("value")))).alias("out")),
        lambda acc: acc["out"]), none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digit string passes the Luhn test."""
    def part(i):
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), part), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether the IBAN (no blanks) leaves 1 by 97 after its first four characters move to the end."""
    turned = F.concat(F.substring(iban, 5, 100), F.substring(iban, 1, 4))

    def step(acc, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, acc * 10 + c - 48).otherwise(acc * 100 + c - 55) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(iban)), F.lit(0), step) == 1


def _apart(text: Column, start: Column, end: Column) -> Column:
    """Whether no letter, digit, plus, dot or dash touches a span."""
    return ~F.concat(F.substring(text, F.greatest(start, F.lit(1)), F.when(start > 0, 1).otherwise(0)), F.lit(" "),
                     F.substring(text, end + 1, F.lit(1))).rlike(r"[A-Za-z0-9+]|[.-]\x20")


def ibans(text: Column, sign: str) -> Column:
    """Spans as of ``positions``: from each start the longest prefix of the pattern, cut at a blank, that stands apart and passes mod-97."""
    def longest(x):
        groups = F.split(F.regexp_extract(F.substring(text, x["start"] + 1, F.lit(IBAN_CHARS)), "^" + IBAN, 0), " ")
        tried = F.transform(F.sequence(F.lit(1), F.size(groups)), lambda n: F.array_join(F.slice(groups, F.lit(1), n), " "))
        valid = F.filter(tried, lambda v: (F.length(F.regexp_replace(v, " ", "")) >= 12) & mod97(F.regexp_replace(v, " ", ""))
                         & _apart(text, x["start"], x["start"] + F.length(v)))
        return F.transform(F.slice(F.reverse(valid), 1, 1), lambda v: F.struct(
            x["start"].alias("start"), (x["start"] + F.length(v)).alias("end"), v.alias("value")))
    found = F.flatten(F.transform(positions(text, IBAN_START, sign), longest))
    # none starts inside the one before
    return F.aggregate(found, F.array().cast("array<struct<start:int,end:int,value:string>>"), lambda acc, x: F.when(
        F.exists(F.slice(F.reverse(acc), 1, 1), lambda y: y["end"] > x["start"]), acc).otherwise(F.concat(acc, F.array(x))))


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(value, " ", ""))
    return F.lit(True)


def _near(text: Column, start: Column, end: Column) -> Column:
    """The lower-cased text around a span."""
    first = F.greatest(start - CONTEXT_CHARS, F.lit(0))
    return F.lower(F.concat(F.substring(text, first + 1, start - first), F.lit(" "),
                            F.substring(text, end + 1, F.lit(CONTEXT_CHARS))))


def findings(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD, out: str = "findings") -> DataFrame:
    """``docs`` with ``out``: array<struct<kind, start, end, value, score>>, by kind as listed, then start."""
    body = F.coalesce(F.col(text), F.lit(""))
    names = [f"__pii_{k.name}" for k in KINDS]
    df = docs.select("*", *[(ibans(body, k.sign) if k.name == "iban" else positions(body, k.pattern, k.sign)).alias(n) for k, n in zip(KINDS, names, strict=True)])

    def scored(k: Kind, spans: Column) -> Column:
        sure = F.filter(spans, lambda x: _confirmed(k.name, x["value"]) & (
            F.lit(True) if k.base else _apart(body, x["start"], x["end"])))
        gain = CHECKSUM_GAIN if k.name in ("card", "iban") else 0.0

        def one(x):
            context = F.when(_near(body, x["start"], x["end"]).rlike(f"(^|[^a-z])({k.context})"), CONTEXT_GAIN).otherwise(0.0)
            return F.struct(F.lit(k.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                            x["value"].alias("value"), F.least(F.lit(1.0), F.round(F.lit(k.prior + gain) + context, 6)).alias("score"))
        spans = F.transform(sure, one)
        return spans if k.base else F.filter(spans, lambda x: x["score"] >= threshold)

    all_spans = F.concat(*[scored(k, F.col(n)) for k, n in zip(KINDS, names, strict=True)])
    return df.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], all_spans.alias(out))


def digests(docs: DataFrame, **options) -> DataFrame:
    """The contract's row of each document."""
    df = findings(docs.select("doc_id", "text"), **options).select("doc_id", "findings")
    base = [k.name for k in KINDS if k.base]
    spell = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of_kind = lambda n: F.filter("findings", lambda x: x["kind"] == n)
    counts = [F.size(of_kind(n)).cast("long").alias(f"n_{n}") for n in base]
    return df.select("doc_id", *counts,
                     F.sha2(spell(F.filter("findings", lambda x: x["kind"].isin(base))), 256).alias("base_sha256"),
                     spell(F.col("findings")).alias("spans"))


def redacted(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` whose text has every finding replaced by ``<KIND>``; overlapping findings become one, named by the first."""
    df = findings(docs, text, out="__found", **options)
    ordered = F.array_sort(F.transform("__found", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("till"), x["kind"].alias("kind"))))
    body = F.col(text)

    def step(acc, x):
        end = -x["till"]
        return F.struct(F.greatest(acc["at"], end).alias("at"),
                        F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(
                            F.substring(body, acc["at"] + 1, x["start"] - acc["at"]), F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))))
                        .otherwise(acc["out"]).alias("out"))
    rebuilt = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step,
                          lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(body, acc["at"] + 1, F.length(body))))
    new = F.when(F.size("__found") > 0, rebuilt).otherwise(body)
    return df.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def oracle_sql() -> str:
    """The contract's rows in DuckDB, with the plain patterns."""
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
             "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": PHONE, "iban": IBAN, "tel": TEL}
    pats = ", ".join(f"({i}, '{k.name}', '{plain[k.name]}', {k.prior}, '(^|[^a-z])({k.context})')" for i, k in enumerate(KINDS, 1))
    counts = ", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in KINDS if k.base)
    sums = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS if k.base)
    return rf"""
WITH pats(k, kind, pat, prior, context) AS (VALUES {pats}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT r, text, k, regexp_extract_all(text, pat) AS hits, regexp_split_to_array(text, pat) AS gaps FROM d, pats),
h AS (SELECT r, text, k, i, hits[i] AS v, length(gaps[i]) AS g FROM m, unnest(range(1, len(hits) + 1)) AS u(i)),
p AS (SELECT r, text, k, v, regexp_replace(v, '[^0-9]', '', 'g') AS digits,
             (sum(g + length(v)) OVER (PARTITION BY r, k ORDER BY i ROWS UNBOUNDED PRECEDING))::BIGINT AS e FROM h),
s AS (SELECT r, text, k, kind, prior, context, v, digits, e - length(v) AS s, e FROM p JOIN pats USING (k)),
c AS (SELECT r, k, kind, s, e FROM s WHERE CASE kind
  WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda x: x::DOUBLE > 255)) = 0
  WHEN 'card' THEN length(digits) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
      CASE WHEN i % 2 = 1 THEN substr(reverse(digits), i, 1)::INT
           WHEN substr(reverse(digits), i, 1)::INT > 4 THEN substr(reverse(digits), i, 1)::INT * 2 - 9
           ELSE substr(reverse(digits), i, 1)::INT * 2 END)) % 10 = 0
  WHEN 'phone' THEN length(digits) BETWEEN 8 AND 15
  WHEN 'iban' THEN list_reduce(list_transform(string_split(replace(substr(v, 5) || substr(v, 1, 4), ' ', ''), ''),
      lambda x: CASE WHEN ascii(x) < 58 THEN ascii(x) - 48 ELSE ascii(x) - 55 END),
      lambda a, x: (CASE WHEN x < 10 THEN a * 10 ELSE a * 100 END + x) % 97) = 1
  ELSE true END
  AND (k <= 4 OR NOT regexp_matches(CASE WHEN s > 0 THEN substr(text, s, 1) ELSE '' END || ' ' || substr(text, e + 1, 1),
                                    '[A-Za-z0-9+]|[.-]\x20')
       AND round(prior + CASE WHEN kind = 'iban' THEN {CHECKSUM_GAIN} ELSE 0 END + CASE WHEN regexp_matches(lower(
           substr(text, greatest(s - {CONTEXT_CHARS}, 0) + 1, s - greatest(s - {CONTEXT_CHARS}, 0)) || ' ' ||
           substr(text, e + 1, {CONTEXT_CHARS})), context) THEN {CONTEXT_GAIN} ELSE 0 END, 6) >= {THRESHOLD})),
a AS (SELECT r, {sums}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans,
             string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k <= 4) AS base FROM c GROUP BY r)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)"""
