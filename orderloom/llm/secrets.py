"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by patterns, with their places. Their values are hashed, and each hash is
counted over the whole corpus by distinct repositories and distinct owners. A value many owners
have is a copied example; a value one owner has, in few repositories, is a live-looking credential
if it isn't a placeholder; the rest is shared. Besides the values with a telling name or form, long mixed
strings are candidates, reported where their frequency makes them look live.

Defined cases: a null or empty text has no candidates; a null owner is an owner of its own;
repeated rows are counted once per repository and reported each; a row with a null id counts as
one repository.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import fresh
from orderloom.sources.shared import keep

# The patterns of the base kinds, in order, with the group that is the value.
ASSIGN = (
    "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"
# Strings without a telling name, long and mixed enough to be keys.
BARE = "[A-Za-z0-9+/_=-]{20,}"

KINDS = ["assign", "access", "hex", "bare"]
# From so many owners on, a value is a copied example.
EXAMPLE_OWNERS = 3
# In so many repositories, a value is passed round even if they all have one owner.
SHARED_REPOSITORIES = 10
PLACEHOLDER = "(?i)example|sample|dummy|placeholder|change_?me|your|xxxx|1234567|abcdef|^(.)\\1*$"


def matches(text: Column, pattern: str, value_group: int) -> Column:
    """Array of (start, end, value) of a pattern's matches, in code points, end exclusive.

    The text is split at the matches, so each starts after the pieces and matches before it.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)) if value_group else found
    items = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), found.alias("whole"), values.alias("value")
    )
    start = F.struct(
        F.lit(0).alias("at"),
        F.expr("cast(array() as array<struct<start: int, end: int, value: string>>)").alias("found"),
    )

    def step(state: Column, item: Column) -> Column:
        low = state["at"] + F.length(item["gap"])
        high = low + F.coalesce(F.length(item["whole"]), F.lit(0))
        one = F.struct(low.alias("start"), high.alias("end"), item["value"].alias("value"))
        more = F.when(item["whole"].isNotNull(), F.concat(state["found"], F.array(one)))
        return F.struct(high.alias("at"), F.coalesce(more, state["found"]).alias("found"))

    none = F.expr("cast(array() as array<struct<start: int, end: int, value: string>>)")
    return F.when(text.rlike(pattern), F.aggregate(items, start, step)["found"]).otherwise(none)


def of_kind(found: Column, kind: int) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(kind).alias("kind"),
            m["end"].alias("end"),
            m["value"].alias("value"),
        ),
    )


def base_kinds(text: Column) -> Column:
    """Array of (start, kind, end, value) of the base kinds."""
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 8)
    access = F.filter(matches(text, ACCESS, 0), lambda m: F.length(m["value"]) >= 16)
    return F.concat(of_kind(assign, 0), of_kind(access, 1), of_kind(matches(text, HEX, 0), 2))


def bare(text: Column, base: Column) -> Column:
    """The same of mixed strings that overlap no base span."""
    mixed = F.filter(
        matches(text, BARE, 0),
        lambda m: m["value"].rlike("[A-Za-z]")
        & m["value"].rlike("[0-9]")
        & (F.size(F.array_remove(F.array_distinct(F.split(m["value"], "")), "")) >= 10),
    )
    outside = F.filter(
        mixed, lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
    )
    return of_kind(outside, 3)


def findings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source"
) -> DataFrame:
    """One row per document: row, doc_id and found, an array ordered by place and kind of
    (start, kind, end, value, owners, repositories, verdict). Bare strings that don't look live
    are left out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        text.alias("text"),
    )
    rows = rows.withColumn("base", base_kinds(F.col("text")))
    rows = rows.select("row", "doc_id", "owner", F.concat("base", bare(F.col("text"), F.col("base"))).alias("all"))
    # Written once, so that the row numbers hold.
    rows = keep(rows, "candidates")
    each = rows.select("row", "doc_id", "owner", F.explode("all").alias("c")).select(
        "row", "doc_id", "owner", "c.*", F.sha2("c.value", 256).alias("hash")
    )
    frequency = each.groupBy("hash").agg(
        F.count_distinct("owner").alias("owners"),
        F.count_distinct(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("repositories"),
    )
    verdict = (
        F.when(F.col("owners") >= EXAMPLE_OWNERS, "example")
        .when(
            (F.col("owners") == 1)
            & (F.col("repositories") < SHARED_REPOSITORIES)
            & ~F.col("value").rlike(PLACEHOLDER),
            "live",
        )
        .otherwise("shared")
    )
    judged = (
        # A table of its own, so that the join may split a value that many rows have.
        each.join(keep(frequency, "frequency"), "hash")
        .withColumn("verdict", verdict)
        .filter((F.col("kind") < 3) | (F.col("verdict") == "live"))
    )
    columns = ["start", "kind", "end", "value", "owners", "repositories", "verdict"]
    listed = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("found"))
    return rows.select("row", "doc_id").join(listed, "row", "left")


def joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda m: F.concat_ws(
                ":", F.element_at(names, m["kind"] + 1), m["start"].cast("string"), m["end"].cast("string")
            ),
        ),
        ",",
    )


def span_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    none = F.expr(
        "cast(array() as array<struct<start: int, kind: int, end: int, value: string, "
        "owners: bigint, repositories: bigint, verdict: string>>)"
    )
    found = findings(docs).withColumn("found", F.coalesce("found", none))
    base = F.filter("found", lambda m: m["kind"] < 3)

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda m: m["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The rows of `docs` with each secret that isn't a copied example replaced by `mask`."""
    row, spans_of = fresh(docs.columns, "row", "spans")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    numbered = keep(numbered, "numbered")
    found = findings(numbered.select(F.col(row).alias("doc_id"), "text", "source"))
    secret = F.filter("found", lambda m: m["verdict"] != "example")
    spans = F.transform(secret, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    found = found.select(F.col("doc_id").alias(row), spans.alias(spans_of))
    found = found.filter(F.size(spans_of) > 0)
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        before = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], before, F.lit(mask))).otherwise(state["out"]).alias("out"),
        )

    done = F.aggregate(spans_of, start, step)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    changed = F.when(F.col(spans_of).isNotNull(), F.concat(done["out"], rest)).otherwise(text)
    out = numbered.join(found, row, "left").withColumn("text", changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\\x20", " ") + "'"


# What `span_digests` returns for the table documents, for DuckDB.
ORACLE = f"""
    WITH docs AS (
        SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS text,
               coalesce(source, '') AS owner FROM documents),
    matched AS (
        SELECT row_no, 0 AS kind, string_split_regex(text, {_sql(ASSIGN)}) AS gaps,
               regexp_extract_all(text, {_sql(ASSIGN)}, 0) AS wholes,
               regexp_extract_all(text, {_sql(ASSIGN)}, 2) AS found FROM docs
        UNION ALL SELECT row_no, 1, string_split_regex(text, {_sql(ACCESS)}),
               regexp_extract_all(text, {_sql(ACCESS)}), regexp_extract_all(text, {_sql(ACCESS)}) FROM docs
        UNION ALL SELECT row_no, 2, string_split_regex(text, {_sql(HEX)}),
               regexp_extract_all(text, {_sql(HEX)}), regexp_extract_all(text, {_sql(HEX)}) FROM docs
        UNION ALL SELECT row_no, 3, string_split_regex(text, {_sql(BARE)}),
               regexp_extract_all(text, {_sql(BARE)}), regexp_extract_all(text, {_sql(BARE)}) FROM docs),
    places AS (
        SELECT row_no, kind, gaps, wholes, found, unnest(range(1, len(wholes) + 1)) AS i
        FROM matched WHERE len(wholes) > 0),
    spans AS (
        SELECT row_no, kind, found[i] AS value, length(wholes[i]) AS size,
               list_sum(list_transform(gaps[1:i], lambda x: length(x)))
               + coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: length(x))), 0) AS low
        FROM places),
    base AS (
        SELECT row_no, kind, value, low, low + size AS high FROM spans
        WHERE kind = 0 AND length(value) >= 8 OR kind = 1 AND length(value) >= 16 OR kind = 2),
    every AS (
        SELECT * FROM base
        UNION ALL
        SELECT row_no, kind, value, low, low + size FROM spans
        WHERE kind = 3 AND regexp_matches(value, '[A-Za-z]') AND regexp_matches(value, '[0-9]')
          AND len(list_distinct(string_split(value, ''))) >= 10
          AND NOT EXISTS (SELECT 1 FROM base b WHERE b.row_no = spans.row_no
                          AND b.low < spans.low + spans.size AND spans.low < b.high)),
    frequency AS (
        SELECT value, count(DISTINCT owner) AS owners,
               count(DISTINCT coalesce(doc_id::VARCHAR, '')) AS repositories
        FROM every JOIN docs USING (row_no) GROUP BY value),
    kept AS (
        SELECT every.*, [{", ".join(f"'{k}'" for k in KINDS)}][kind + 1] || ':' || low::BIGINT || ':' || high::BIGINT AS name
        FROM every JOIN frequency USING (value)
        WHERE kind < 3 OR owners = 1 AND repositories < {SHARED_REPOSITORIES} AND NOT regexp_matches(value, {_sql(PLACEHOLDER.rpartition("|")[0])})
              AND replace(value, value[1], '') <> ''),
    listed AS (
        SELECT row_no, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex,
               string_agg(name, ',' ORDER BY low, kind) FILTER (kind < 3) AS base_spans,
               string_agg(name, ',' ORDER BY low, kind) AS spans
        FROM kept GROUP BY row_no)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
           coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM docs LEFT JOIN listed USING (row_no)"""
