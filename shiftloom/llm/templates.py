"""Line dedup with a tree of log templates, in DataFrame functions only.

Lines are tokens between blanks; a token with a digit is a variable field, ``<*>``. The tree has a
fixed depth: the token count, then the first ``DEPTH`` tokens. Inside a leaf a token stays in the
template if ``MIN_DOCS`` pairs of a document and a line have it at this place; otherwise the place
is a variable field as well. A template recurs if at least half its places are fixed and lines
of ``MIN_DOCS`` documents fall under it. Its first line (by doc_id, then place) stays, all others
are dropped. Lines of fewer than ``MIN_TOKENS`` tokens are never judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .texts import fresh, numbered, settle

DEPTH, MIN_DOCS, MIN_TOKENS = 3, 3, 3
FIELD = "<*>"
BLANKS = " \t\r\f\x0b"
WORD_BITS = 64


def _variable(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), FIELD).otherwise(token)


def split_lines(docs: DataFrame) -> DataFrame:
    """One row per line to judge, with its place, its tokens between single blanks, and their count."""
    lines = docs.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    content = F.col("content")
    # The costly pattern is applied only to lines with anything but single spaces between tokens.
    odd = content.startswith(" ") | content.endswith(" ") | content.contains("  ")
    for blank in BLANKS[1:]:
        odd |= content.contains(blank)
    spaced = F.when(odd, F.trim(F.regexp_replace(content, "[ \\t\\r\\f\\x0B]+", " "))).otherwise(content)
    lines = lines.select("row", "doc_id", "line", spaced.alias("content"))
    blanks = F.octet_length("content") - F.octet_length(F.replace("content", F.lit(" "), F.lit("")))
    return lines.withColumn("n", blanks + 1).where(F.col("n") >= MIN_TOKENS)


def _masked(text: Column) -> Column:
    return F.transform(F.split(text, " "), _variable)


def dropped_lines(docs: DataFrame) -> DataFrame:
    """``row`` and ``line`` of the lines to drop from ``docs`` (doc_id, text, row).

    Equal lines are known by a digest of 128 bits, leaves by their count and a hash of 64 bits.
    """
    lines = split_lines(docs)
    lead = F.substring_index("content", " ", DEPTH)
    lines = lines.withColumn("branch", F.xxhash64("n", _masked(lead)))
    # Only branches that lines of two documents share go on. The list is written, so Spark knows
    # its size and sends it to all tasks only if it is small.
    shared = settle(
        lines.groupBy("branch").agg(F.count("*").alias("all"), F.min("row").alias("a"), F.max("row").alias("b"))
        .where((F.col("all") >= MIN_DOCS) & (F.col("a") < F.col("b"))).select("branch")
    )
    found = lines.join(shared, "branch", "left_semi").withColumn("masked", F.array_join(_masked(F.col("content")), " "))
    found = settle(found.select("row", "doc_id", "line", "n", "branch", "masked", F.unhex(F.md5("masked")).alias("key")))

    docs_of = found.select("key", "row").distinct().groupBy("key").agg(F.count("*").alias("docs"))
    kinds = found.groupBy("key").agg(*[F.any_value(c).alias(c) for c in ("n", "branch", "masked")])
    kinds = settle(kinds.join(docs_of, "key"))
    leaves = kinds.groupBy("n", "branch").agg(F.count("*").alias("kinds"), F.sum("docs").alias("lines"))
    # A leaf of one kind of line has nothing to generalise: its template is the line.
    alone = leaves.where((F.col("kinds") == 1) & (F.col("lines") >= MIN_DOCS))
    mixed = leaves.where((F.col("kinds") > 1) & (F.col("lines") >= MIN_DOCS))
    tokens = F.split("masked", " ")
    known = kinds.join(alone, ["n", "branch"], "left_semi").withColumn("fixed", F.size(F.filter(tokens, lambda t: t != FIELD)))
    places = kinds.join(mixed, ["n", "branch"], "left_semi").select(
        "key", "n", "branch", "docs", F.posexplode(tokens).alias("place", "token")
    )
    support = places.groupBy("n", "branch", "place", "token").agg(F.sum("docs").alias("support"))
    fixed = (F.col("support") >= MIN_DOCS) & (F.col("token") != FIELD)
    shown = places.join(support, ["n", "branch", "place", "token"]).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("place", F.when(fixed, F.col("token")).otherwise(FIELD).alias("token")))).alias("parts"),
        F.any_value("n").alias("n"), F.count_if(fixed).alias("fixed"),
    ).withColumn("masked", F.array_join("parts.token", " "))
    templates = known.select("key", "n", "fixed", "masked").unionByName(shown.select("key", "n", "fixed", "masked"))
    templates = templates.where(F.col("fixed") * 2 >= F.col("n")).select("key", F.unhex(F.md5("masked")).alias("template"))
    placed = found.join(templates, "key").select("template", "row", "line", F.col("doc_id").isNull().alias("none"), "doc_id")
    often = placed.select("template", "row").distinct().groupBy("template").agg(F.count("*").alias("docs"))
    place = F.struct("none", "doc_id", "row", "line")
    first = placed.groupBy("template").agg(F.min(place).alias("first"))
    recurring = often.where(F.col("docs") >= MIN_DOCS).join(first, "template").select("template", "first")
    again = placed.join(recurring, "template").where(
        (F.col("row") != F.col("first.row")) | (F.col("line") != F.col("first.line"))
    )
    return again.select("row", "line")


def without_templates(docs: DataFrame, lines_as: str | None = None, dropped_as: str | None = None) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``, and counts of lines under the names that are given.

    All rows stay, also those that lose all their lines (their text becomes empty). A null text
    stays null and has no lines, an empty one has one empty line. Repeated rows are documents of
    their own; a null ``doc_id`` comes last when the first line is chosen. ``docs`` must be read
    from a stored table.
    """
    gone = dropped_lines(numbered(docs.select("doc_id", "text"), "row"))
    bits = gone.groupBy("row", F.floor(F.col("line") / WORD_BITS).cast("int").alias("block")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("line") % WORD_BITS)).alias("bits"),
        F.count("*").alias("n"),
    )
    marks = bits.groupBy("row").agg(F.collect_list(F.struct("block", "bits")).alias("blocks"), F.sum("n").alias("n_dropped"))
    dense = F.transform(
        F.sequence(F.lit(0), F.array_max("blocks.block")),
        lambda b: F.coalesce(F.get(F.filter("blocks", lambda x: x["block"] == b), F.lit(0))["bits"], F.lit(0).cast("bigint")),
    )
    place, bits, dropped = fresh(docs, "row"), fresh(docs, "bits"), fresh(docs, "dropped")
    marks = marks.select(F.col("row").alias(place), dense.alias(bits), F.col("n_dropped").alias(dropped))
    joined = numbered(docs, place).join(marks, place, "left")
    lines = F.split("text", "\n")
    word = lambda i: F.coalesce(F.get(F.col(bits), F.floor(i / WORD_BITS).cast("int")), F.lit(0).cast("bigint"))
    stay = F.filter(lines, lambda x, i: F.getbit(word(i), i % WORD_BITS) == 0)
    text = F.when(F.col(bits).isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(bits).isNull(), F.col("n_chars")).otherwise(F.length(text).cast("bigint"))
    counts = {lines_as: F.coalesce(F.size(lines), F.lit(0)), dropped_as: F.coalesce(dropped, F.lit(0))}
    return joined.select(
        *[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns],
        *[count.cast("bigint").alias(name) for name, count in counts.items() if name],
    )


def report(docs: DataFrame) -> DataFrame:
    return without_templates(docs.select("doc_id", "text"), "n_lines", "n_dropped").select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


SQL = f"""
WITH lines AS (
    SELECT doc_id, place.i AS line, place.content AS content
    FROM documents, LATERAL (
        SELECT unnest(string_split(text, chr(10))) AS content, unnest(range(len(string_split(text, chr(10))))) AS i
    ) place
), cut AS (
    SELECT doc_id, line,
        [CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END
         FOR t IN string_split_regex(trim(content, ' ' || chr(9) || chr(13) || chr(12) || chr(11)), '[ \\t\\r\\f\\x0B]+')] AS tokens
    FROM lines
), judged AS (
    SELECT doc_id, line, tokens, array_to_string(tokens, ' ') AS masked FROM cut WHERE len(tokens) >= {MIN_TOKENS}
), kinds AS (
    SELECT masked, any_value(tokens) AS tokens, count(DISTINCT doc_id) AS docs FROM judged GROUP BY masked
), places AS (
    SELECT masked, docs, len(tokens) AS n, tokens[1:{DEPTH}] AS lead,
        unnest(tokens) AS token, unnest(range(len(tokens))) AS i
    FROM kinds
), support AS (
    SELECT *, sum(docs) OVER (PARTITION BY n, lead, i, token) >= {MIN_DOCS} AND token <> '{FIELD}' AS fixed FROM places
), templates AS (
    SELECT masked, string_agg(CASE WHEN fixed THEN token ELSE '{FIELD}' END, ' ' ORDER BY i) AS template
    FROM support GROUP BY masked HAVING count(*) FILTER (fixed) * 2 >= count(*)
), placed AS (
    SELECT template, doc_id, line FROM judged JOIN templates USING (masked)
), often AS (
    SELECT template, min((doc_id, line)) AS first FROM placed GROUP BY template HAVING count(DISTINCT doc_id) >= {MIN_DOCS}
), gone AS (
    SELECT doc_id, line FROM placed JOIN often USING (template) WHERE (doc_id, line) <> first
)
SELECT d.doc_id, count(l.line) AS n_lines, count(g.line) AS n_dropped,
    sha256(coalesce(string_agg(l.content, chr(10) ORDER BY l.line) FILTER (g.line IS NULL), '')) AS kept_sha256
FROM documents d LEFT JOIN lines l USING (doc_id) LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line
GROUP BY d.doc_id
"""
