"""URL filters: host and path rules, and their decisions carried over redirects and canonical links.

Every url is taken apart into host, path and query.  A rule (verdict, host,
path) fits its host and all subdomains where the url's path starts with the
rule's; the longest fitting rule decides.  What no rule decides is judged by the
pages it is an alias of: canonical links and refresh redirects of the html, and
a table of crawled redirects where one is given, are edges between urls (without
scheme and fragment), and their connected components are the alias classes.

* an explicit rule of a url always stands, whatever its class says;
* a class with an explicitly allowed url is allowed, also where another is blocked;
* else a class with a blocked url is blocked, for all of its aliases;
* else, and outside all classes, a url is allowed.

A url that is only linked, and on no page, counts by its own rule too.

Only DataFrame functions run here.  The html is read once, for its link and meta
tags; the components are found by joins and aggregates over the distinct edges;
the pages meet the decided urls in one join, whose keys are salted because one
url or one class may hold a large share of all rows.

Results: a null url, or one without ``://``, has empty host and path, no rule and
no aliases, and is allowed; null and empty html has no edges; repeated rows each
get their own result; an empty table gives an empty result; other columns, of
whatever name, are ignored unless listed in ``keep``.  Comments and scripts are
skipped, in time linear in the html.  Not read: ``<base>``, and tags with ``<``
or ``>`` in an attribute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components

# The contract's rules (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
DEFAULT = "allow"
#: parts that each decided url and class is copied to, so that a hot one meets its rows in as many tasks
SALTS = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAG = r"(?i)<(?:link|meta)\s[^<>]*+>"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
#: seconds, then the target of a refresh
REFRESH = r"^\s*[0-9]*(?:\.[0-9]*)?\s*[;,]\s*(?:(?i:url)\s*=\s*)?[\"']?([^\"']+)"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://`` of a url, null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(after: Column) -> Column:
    return F.translate(F.regexp_extract(after, "^[^/?#]*", 0), UPPER, LOWER)


def path_of(after: Column) -> Column:
    return F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def key_of(after: Column) -> Column:
    """The url without scheme and fragment, its host lower-cased: the node of the alias graph."""
    return F.concat(host_of(after), path_of(after), F.regexp_extract(after, r"^[^?#]*(\?[^#]*)", 1))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct<rule, verdict> of the longest rule that fits, null without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?i)\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.replace(F.trim(F.translate(value, "\t\n\r\f", "    ")), F.lit("&amp;"), F.lit("&"))


def _visible(html: Column) -> Column:
    """The html without comments and scripts: what stands before the opening of each closed part."""
    def cut(text, close, opened):
        return F.array_join(F.transform(F.split(text, close, -1), lambda part: F.split(part, opened, 2)[0]), " ")
    return cut(cut(html, "-->", "<!--"), r"(?i)</script\s*>", r"(?i)<script\b")


def _without_dots(path: Column) -> Column:
    """``path`` with its . and .. segments resolved."""
    def step(done, segment):
        return (F.when(segment == ".", done)
                .when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
                .otherwise(F.concat(done, F.array(segment))))
    clean = F.array_join(F.aggregate(F.split(path, "/", -1), F.array().cast("array<string>"), step), "/")
    return F.when(F.contains(path, F.lit("/.")), clean).otherwise(path)


def _resolved(target: Column, host: Column, path: Column) -> Column:
    """The key of a link's target, seen from a page; null where it is no other url."""
    directory = F.regexp_extract(path, "^(.*/)", 1)
    rest = F.regexp_extract(target, "^([^?#]*)", 1)
    query = F.regexp_extract(target, r"^[^?#]*(\?[^#]*)", 1)
    return (F.when((target == "") | F.startswith(target, F.lit("#")), F.lit(None))
            .when(target.rlike(r"(?i)^https?://"), key_of(_after_scheme(target)))
            .when(F.startswith(target, F.lit("//")), key_of(F.substring(target, F.lit(3), F.length(target))))
            .when(target.rlike(SCHEME), F.lit(None))
            .when(F.startswith(target, F.lit("/")), F.concat(host, _without_dots(rest), query))
            .when(F.startswith(target, F.lit("?")), F.concat(host, path, query))
            .otherwise(F.concat(host, _without_dots(F.concat(F.when(directory == "", F.lit("/")).otherwise(directory), rest)), query)))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """a, b: keys of each page and of the urls that its canonical links and refresh redirects name."""
    after = _after_scheme(F.col(url))
    tags = F.regexp_extract_all(_visible(F.col(html)), F.lit(TAG), F.lit(0))
    marked = (pages.where(F.col(html).rlike(r"(?i)canonical|refresh") & after.isNotNull())
              .select(host_of(after).alias("host"), path_of(after).alias("path"), key_of(after).alias("a"), F.explode(tags).alias("tag")))
    canonical = F.when(F.col("tag").rlike(r"(?i)\srel\s*=\s*[\"']?canonical[\"'\s/>]"), _attribute(F.col("tag"), "href"))
    refresh = F.when(F.col("tag").rlike(r"(?i)\shttp-equiv\s*=\s*[\"']?refresh[\"'\s/>]"),
                     F.trim(F.regexp_extract(_attribute(F.col("tag"), "content"), REFRESH, 1)))
    target = F.coalesce(canonical, refresh)
    return marked.select("a", _resolved(target, F.col("host"), F.col("path")).alias("b")).where("b is not null and b <> a")


def _salted_join(many: DataFrame, few: DataFrame, on: str, how: str) -> DataFrame:
    """``many`` joined with the table ``few`` of unique ``on``; a hot value meets its rows in ``SALTS`` tasks."""
    few = few.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("__salt", (F.rand(13) * SALTS).cast("int")).join(few, [on, "__salt"], how).drop("__salt")


def aliases(edges: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """__key, __alias_of (the least url of its class), __class_verdict (null: undecided) of every url on an edge (columns a, b)."""
    found = components(edges.where("a <> b").distinct(), "url-aliases")
    own = longest_rule(F.regexp_extract("node", "^[^/?]*", 0), F.regexp_extract("node", r"^[^/?]*([^?]*)", 1), rules)["verdict"]
    classes = found.groupBy("component").agg(F.max(own == "allow").alias("allowed"), F.max(own == "block").alias("blocked"))
    verdict = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
    joined = _salted_join(found, classes.select("component", verdict.alias("__class_verdict")), "component", "inner")
    return joined.select(F.col("node").alias("__key"), F.col("component").alias("__alias_of"), "__class_verdict")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None, url: str = "url",
          html: str | None = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict and alias_of (the least url of the alias class, null outside all).

    ``redirects`` has the columns source and target: urls of crawled redirects.
    """
    edges = links(pages, url, html) if html else None
    if redirects is not None:
        crawled = redirects.select(key_of(_after_scheme(F.col("source"))).alias("a"), key_of(_after_scheme(F.col("target"))).alias("b")).dropna()
        edges = crawled if edges is None else edges.unionByName(crawled)
    after = _after_scheme(F.col(url))
    rows = pages.select(*[F.col(c) for c in keep], F.coalesce(host_of(after), F.lit("")).alias("host"),
                        F.coalesce(path_of(after), F.lit("")).alias("path"), key_of(after).alias("__key"))
    rows = rows.withColumn("__own", longest_rule(F.col("host"), F.col("path"), rules))
    if edges is None:
        rows = rows.withColumns({"__alias_of": F.lit(None).cast("string"), "__class_verdict": F.lit(None).cast("string")})
    else:
        # rows without a key have no aliases; a random one keeps them out of one task
        rows = rows.withColumn("__key", F.coalesce("__key", F.concat(F.lit("\x00"), F.rand(7).cast("string"))))
        rows = _salted_join(rows, aliases(edges, rules), "__key", "left")
    return rows.select(*keep, "host", "path", F.col("__own.rule").alias("rule"),
                       F.coalesce(F.col("__own.verdict"), F.col("__class_verdict"), F.lit(DEFAULT)).alias("verdict"),
                       F.col("__alias_of").alias("alias_of"))


def digests(pages: DataFrame) -> DataFrame:
    """The contract's row of each page."""
    return judge(pages)


def oracle_sql() -> str:
    """The same rows in DuckDB; classes by reachability."""
    fits = "(host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)"
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)

    def attribute(tag, name):
        pattern = rf"(?i)\s{name}\s*=\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\s\"''>]+))"
        groups = " || ".join(f"regexp_extract({tag}, '{pattern}', {i})" for i in (1, 2, 3))
        return f"replace(trim(translate({groups}, chr(9) || chr(10) || chr(13) || chr(12), '    ')), '&amp;', '&')"

    def key(after):
        return (f"translate(regexp_extract({after}, '^[^/?#]*'), '{UPPER}', '{LOWER}') || regexp_extract({after}, '^[^/?#]*([^?#]*)', 1)"
                f" || regexp_extract({after}, '^[^?#]*(\\?[^#]*)', 1)")

    refresh = REFRESH.replace("'", "''")
    return rf"""
WITH RECURSIVE rules(v, h, p) AS (VALUES {values}),
u AS (SELECT row_number() OVER () AS r, page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
k AS (SELECT r, page_id, html, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path, {key('rest')} AS key FROM u),
tags AS (SELECT key, host, path, unnest(regexp_extract_all(regexp_replace(regexp_replace(html, '<!--(?:[^-]|-[^-]|--+[^->])*--+>', ' ', 'g'),
             '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?i)<(?:link|meta)\s[^<>]*>')) AS tag FROM k WHERE key IS NOT NULL),
t AS (SELECT key, host, path, coalesce(
        CASE WHEN regexp_matches(tag, '(?i)\srel\s*=\s*["'']?canonical["''\s/>]') THEN {attribute('tag', 'href')} END,
        CASE WHEN regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh["''\s/>]') THEN trim(regexp_extract({attribute('tag', 'content')}, '{refresh}', 1)) END) AS target FROM tags),
links AS (SELECT key AS a, CASE WHEN target = '' OR target[1] = '#' THEN NULL
        WHEN regexp_matches(target, '(?i)^https?://') THEN {key("substr(target, strpos(target, '://') + 3)")}
        WHEN starts_with(target, '//') THEN {key("substr(target, 3)")}
        WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
        WHEN target[1] = '/' THEN host || regexp_extract(target, '^[^#]*')
        WHEN target[1] = '?' THEN host || path || regexp_extract(target, '^[^#]*')
        ELSE host || CASE WHEN strpos(path, '/') = 0 THEN '/' ELSE regexp_extract(path, '^.*/') END || regexp_extract(target, '^[^#]*') END AS b FROM t),
edges AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
class AS (SELECT a AS key, min(b) AS component FROM reach GROUP BY a),
fit AS (SELECT key, v, h, p FROM (SELECT key, regexp_extract(key, '^[^/?]*') AS host, regexp_extract(key, '^[^/?]*([^?]*)', 1) AS path FROM class), rules WHERE {fits}),
own AS (SELECT key, arg_max(v, length(h || p)) AS v FROM fit GROUP BY key),
said AS (SELECT component, bool_or(v = 'allow') AS allowed, bool_or(v = 'block') AS blocked FROM class LEFT JOIN own USING (key) GROUP BY component),
mine AS (SELECT r, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM k, rules WHERE {fits} GROUP BY r)
SELECT page_id, host, path, rule, coalesce(mine.v, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, '{DEFAULT}') AS verdict, component AS alias_of
FROM k LEFT JOIN mine USING (r) LEFT JOIN class USING (key) LEFT JOIN said USING (component)"""
