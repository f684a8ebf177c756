"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies.

Words are maximal runs of ASCII letters and digits, A to Z lower-cased; a shingle is five of them. For every template of
m distinct shingles the text is read in windows of m consecutive shingles, one at each place. A window matches
if it holds at least 0.8 of the template's distinct shingles. Such a window's Jaccard similarity to the template is at
least 0.8 / 1.2; with ``BANDS`` bands of ``ROWS`` values the two share a band with probability
1 - (1 - (2/3) ** 2) ** 24 > 0.9999992, and surely where they are equal. Windows with fewer than 0.8 * m shingles of any
template cannot match and are not hashed.

All of it is DataFrame functions. Templates are taken in groups of ``GROUP_SHINGLES`` shingles at most; a group's shingles
are a literal set, its bands a broadcast table of ``BANDS`` rows for each template. A larger library makes more groups, not
larger ones, and each group reads the texts again.

Defined results: null texts, and texts of fewer than five words, match nothing; rows that share a doc_id are scanned each
and merged by doc_id (a null doc_id is an id like any other); templates of fewer than five words are not allowed; long texts
are read in parts of ``PART`` windows, so a text full of notices never makes one large array; extra columns play no
part; without documents there are no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import TEMPLATES

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 24
ROWS = 2

#: Shingles of all templates that one reading of the texts looks for.
GROUP_SHINGLES = 50_000
#: Places at which the windows of one part of a text begin.
PART = 4096

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _with_shingles(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with ``s``, the hashes of the text's shingles in order, in place of the text.

    The hashed words are a column of their own: inside a lambda function they would be computed anew for each shingle.
    """
    hashed = rows.withColumn("h", _word_hashes(F.col(text))).drop(text)
    last = F.size("h") - SHINGLE
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(SHINGLE)]))
    return hashed.withColumn("s", F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))).drop("h")


def _bands(shingles: str) -> Column:
    """An array of band keys: each hashes ROWS least values of the shingles under as many seeds."""

    def least(seed: Column) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, seed)))

    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, *[least(b * ROWS + r) for r in range(ROWS)]))


def template_table(like: DataFrame, templates: dict[str, str]) -> DataFrame:
    rows = like.sparkSession.createDataFrame(sorted(templates.items()), "license string, notice string")
    return _with_shingles(rows, "notice").select("license", F.array_distinct("s").alias("want")).withColumn("m", F.size("want"))


def groups(templates: dict[str, str], most: int = GROUP_SHINGLES) -> list[dict[str, str]]:
    """The templates in groups of at most so many words (one longer template is a group of its own)."""
    out: list[dict[str, str]] = []
    size = most
    for name, text in sorted(templates.items()):
        n = len(text.split())
        if size + n > most:
            out.append({})
            size = 0
        out[-1][name] = text
        size += n
    return out


def scan(documents: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """One row per document and license found: doc_id, license, containment (the best), first_word, n_windows."""
    return reduce(DataFrame.unionByName, [_scan(documents, own) for own in groups(templates)])


def _scan(documents: DataFrame, templates: dict[str, str]) -> DataFrame:
    table = template_table(documents, templates)
    known = table.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("want")))), F.array_sort(F.collect_set("m"))).first()
    docs = _with_shingles(documents.select("doc_id", "text"), "text").withColumn("total", F.size("s"))
    docs = docs.withColumn("base", F.explode(F.sequence(F.lit(0), F.greatest(F.col("total") - 1, F.lit(0)), F.lit(PART))))
    docs = docs.withColumn("s", F.slice("s", F.col("base") + 1, PART + known[1][-1] - 1))
    places = F.transform("s", lambda s, i: F.when(s.isin(known[0]), i))
    docs = docs.withColumn("hits", F.filter(places, lambda i: i.isNotNull()))
    none = F.array().cast("array<int>")

    def windows(m: Column) -> Column:
        """Of m shingles, those with enough hits to match; they end within the text if it has as many."""
        need = F.ceil(m * CONTAINMENT - 1e-9).cast("int")
        last = F.greatest(F.col("total") - m, F.lit(0)) - F.col("base")

        def begins(j: Column) -> Column:
            first, stop = F.get("hits", j), F.get("hits", j + need - 1)
            low, high = F.greatest(stop - m + 1, F.lit(0)), F.least(first, last, F.lit(PART - 1))
            return F.when((stop - first < m) & (low <= high), F.sequence(low, high)).otherwise(none)

        found = F.when(F.size("hits") >= need, F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size("hits") - need), begins)))).otherwise(none)
        return F.transform(found, lambda at: F.struct(m.alias("m"), (at + F.col("base")).alias("at"), F.slice("s", at + 1, m).alias("have")))

    sizes = F.array(*map(F.lit, known[1]))
    read = docs.select("doc_id", F.explode(F.flatten(F.transform(sizes, windows))).alias("w")).select("doc_id", "w.m", "w.at", "w.have")
    banded = read.select("doc_id", "m", "at", "have", F.posexplode(_bands("have")).alias("band", "key"))
    wanted = table.select("license", "want", "m", F.posexplode(_bands("want")).alias("band", "key"))
    found = banded.join(F.broadcast(wanted), ["m", "band", "key"])  # BANDS rows for each of a group's templates
    share = F.size(F.array_intersect("want", "have")) / F.col("m")
    verified = found.withColumn("share", share).where(F.col("share") >= CONTAINMENT)
    once = verified.groupBy("doc_id", "license", "at").agg(F.max("share").alias("share"))  # a window may meet its template in many bands
    return once.groupBy("doc_id", "license").agg(F.max("share").alias("containment"), F.min("at").cast("long").alias("first_word"), F.count("*").alias("n_windows"))


def oracle_sql(templates: dict[str, str] = TEMPLATES) -> str:
    """DuckDB SQL: every window against every template, without MinHash."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(templates.items()))
    lower = f"translate({{}}, '{_UPPER}', '{_LOWER}')"
    words = "list_filter(string_split_regex(" + lower + ", '[^a-z0-9]+'), lambda w: w <> '')"
    shingles = "list_transform(range(greatest(len(w) - 4, 0)), lambda i: array_to_string(w[i + 1 : i + 5], ' '))"
    return f"""
WITH t0(license, notice) AS (VALUES {values}),
t1 AS (SELECT license, {words.format("notice")} AS w FROM t0),
t AS (SELECT license, list_distinct({shingles}) AS want, len(list_distinct({shingles})) AS m FROM t1),
d0 AS (SELECT row_number() OVER () AS r, doc_id, {words.format("coalesce(text, '')")} AS w FROM documents),
d AS (SELECT r, doc_id, {shingles} AS s FROM d0),
every AS (SELECT r, len(s) AS n, unnest(s) AS x, unnest(range(len(s))) AS i FROM d),
hit AS (SELECT r, n, i, license, m, t.x FROM every JOIN (SELECT license, m, unnest(want) AS x FROM t) t USING (x)),
win AS (SELECT DISTINCT r, license, m, unnest(range(least(greatest(i - m + 1, 0), greatest(n - m, 0)), least(i, greatest(n - m, 0)) + 1)) AS p FROM hit),
ver AS (SELECT w.r, w.license, p, count(DISTINCT h.x) / CAST(w.m AS DOUBLE) AS share FROM win w JOIN hit h ON h.r = w.r AND h.license = w.license AND h.i BETWEEN p AND p + w.m - 1 GROUP BY w.r, w.license, w.m, p),
best AS (SELECT doc_id, license, p, max(share) AS share FROM ver JOIN (SELECT r, doc_id FROM d0) USING (r) WHERE share >= 0.8 GROUP BY doc_id, license, p)
SELECT doc_id, license, max(share) AS containment, CAST(min(p) AS BIGINT) AS first_word, CAST(count(*) AS BIGINT) AS n_windows FROM best GROUP BY doc_id, license"""
