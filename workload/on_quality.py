"""Checks, reconciliation, small cells, metadata and the publish gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktide.fixed_values import (
    METADATA_REQUIRED,
    NATIONAL_SPECIALTY,
    SUPPRESSED_HOSPITAL_LABEL,
    WIDE,
    WIDE_BANDS,
    WIDE_TABLE_COUNTS,
)
from stocktide.operators import clean, governance, joins, quality, record_schema
from stocktide.operators.totals import eligible
from stocktide.shared_dir import new_folder
from stocktide.sources import profiles, raw_store
from stocktide.sources.catalogue import HOSPITAL_DATASETS

from . import stores, tables
from .on_sources import _DATE_TEXT, _WIDE_SUMS, _WIDE_TEXT
from .registry import query
from .sql import IN_HOSPITAL, iso, with_base, with_unified

_CUSTOMER = (
    ("c_custkey", "bigint"),
    ("c_name", "string"),
    ("c_nationkey", "int"),
    ("c_acctbal", "double"),
    ("c_mktsegment", "string"),
)


@query(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS column_type, count(*) AS n_rows,"
        f" count({name}) AS n_present, count(DISTINCT {name}) AS n_distinct FROM customer"
        for name, kind in _CUSTOMER
    )
)
def column_profile(spark, sf_dir):
    return quality.column_profile(tables.table(spark, sf_dir, "customer"))


_PROFILED = dict(zip(
    ("ArchiveDate", "Adult_Child", "HospitalName", "0-6 Months", "6-12 Months", "12-18 Months", "18 Months +", "Total"),
    ("archive_date", "adult_child", "hospital_name", "months_0_6", "months_6_12", "months_12_18", "months_18_plus",
     "total"),
))


@query(
    with_base(
        "SELECT dataset, column_name, CAST(sum(n * CASE WHEN yr = 2001 THEN 2 ELSE 1 END) AS BIGINT) AS n_rows,"
        " CAST(sum(n_cells * CASE WHEN yr = 2001 THEN 2 ELSE 1 END) AS BIGINT) AS n_present,"
        " any_value(n_distinct) AS n_distinct, true AS is_close,"
        " CAST(count(DISTINCT CASE WHEN yr = 2001 THEN 1 END) AS BIGINT) AS n_profiled_again FROM (\n"
        + "\nUNION ALL ".join(
            f"SELECT dataset, '{name}' AS column_name, yr, count(*) AS n, count({column}) AS n_cells,"
            f" (SELECT count(DISTINCT {column}) FROM wide w WHERE w.dataset = wide.dataset) AS n_distinct"
            " FROM wide GROUP BY dataset, yr"
            for name, column in _PROFILED.items()
        )
        + ") GROUP BY dataset, column_name"
    ).replace(
        "\nSELECT dataset, column_name", f""",
wide AS (SELECT list_type || '_hospital' AS dataset, yr, archive_date, adult_child, hospital_name, {_WIDE_TEXT}
  FROM (SELECT list_type, yr, {_DATE_TEXT} AS archive_date, adult_child, published_name AS hospital_name, {_WIDE_SUMS}
    FROM base WHERE yr >= 2000 GROUP BY ALL))
SELECT dataset, column_name""", 1)  # fmt: skip
)
def profile_refresh(spark, sf_dir):
    """Profiles of loaded wide files, merged from the sketches of their years, next to exact counts. Between two
    refreshes 2001 is published again with each row twice. An estimate is close within five standard errors, 4 per cent."""
    root = new_folder(spark, "profiled")
    landed, raw, at = f"{root}/landing", f"{root}/raw", f"{root}/profiles"

    def load(rows, published):
        tables.write_publication(rows, landed, published)
        raw_store.ingest(spark, landed, raw, years_of_family=tables.YEARS)
        return profiles.refresh(spark, raw, at)

    wide = raw_store.read_raw(spark, stores.raw(spark, sf_dir), WIDE)
    load(wide, tables.FIRST_PUBLICATION)
    later = wide.where("year_key = '2001'")
    again = load(later.union(later), "2002-02-15")
    loaded = raw_store.read_raw(spark, raw, WIDE)
    estimated = profiles.profile(spark, at, "dataset").withColumnRenamed("n_distinct", "estimate")
    parts = []
    for dataset in HOSPITAL_DATASETS:
        exact = quality.column_profile(loaded.where(F.col("dataset") == dataset).drop("dataset", "year_key"))
        parts.append(
            exact.select(
                F.lit(dataset).alias("dataset"), "column_name", "n_distinct",
                F.lit(sum(d == dataset for d, _ in again)).cast("bigint").alias("n_profiled_again"),
            )
        )
    near = F.abs(F.col("estimate") - F.col("n_distinct")) <= F.greatest(F.lit(0.5), 0.04 * F.col("n_distinct"))
    return estimated.join(parts[0].union(parts[1]), ["dataset", "column_name"]).select(
        "dataset", "column_name", "n_rows", "n_present", "n_distinct", near.alias("is_close"), "n_profiled_again"
    )


_DOCUMENT_MARKERS = ("small volume", "<5", "n/a", "license", "http")
_MARKED = " OR ".join(f"contains(lower({{}}), '{m}')" for m in _DOCUMENT_MARKERS)


@query(
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({_MARKED.replace('{}', name)}) AS n_cells,"
        f" coalesce(bool_or({_MARKED.replace('{}', name)}), false) AS found FROM documents"
        for name in ("text", "lang", "source")
    )
)
def marker_scan(spark, sf_dir):
    texts = tables.table(spark, sf_dir, "documents").select("text", "lang", "source")
    return quality.marker_scan(texts, _DOCUMENT_MARKERS)


@query(
    with_unified(
        """SELECT (SELECT bool_or(contains(lower(hospital_name), 'small volume')
      OR contains(lower(specialty_name), 'small volume')) FROM unified) AS marker_found"""
    )
)
def marker_found(spark, sf_dir):
    rows = tables.unified(spark, sf_dir).select("hospital_name", "specialty_name", "time_band")
    return quality.marker_found(rows)


@query("SELECT count(*) AS n_rows FROM supplier")
def refuse_empty(spark, sf_dir):
    rows = clean.require_rows(tables.table(spark, sf_dir, "supplier"))
    return rows.agg(F.count("*").alias("n_rows"))


@query(
    with_unified(
        f"""SELECT {iso('archive_date')} AS archive_date, list_type, adult_child,
    CAST(sum(CASE WHEN granularity = 'hospital' THEN count END) AS BIGINT) AS left_total,
    CAST(sum(CASE WHEN granularity = 'national_specialty' THEN count END) AS BIGINT) AS right_total,
    CAST(sum(CASE WHEN granularity = 'hospital' THEN count ELSE -count END) AS BIGINT) AS difference,
    coalesce(abs(sum(CASE WHEN granularity = 'hospital' THEN count ELSE -count END)) <= 2, false) AS agrees
  FROM unified WHERE granularity <> 'hospital_specialty'
    AND (granularity = 'hospital' OR NOT is_suppressed_bucket OR list_type = 'ipdc') GROUP BY ALL"""
    )
)
def reconcile_granularity(spark, sf_dir):
    """Hospital files against specialty files; outpatient specialties are compared without buckets."""
    rows = tables.observations(spark, sf_dir)
    specialty = rows.where(
        (F.col("granularity") == NATIONAL_SPECIALTY)
        & (~F.col("is_suppressed_bucket") | (F.col("list_type") == "ipdc"))
    )
    by = ["archive_date", "list_type", "adult_child"]
    return quality.reconcile(rows.where("granularity = 'hospital'"), specialty, by, tolerance=2)


@query(
    with_base(
        f"""SELECT CASE WHEN t % 7 = 0 THEN 1 ELSE 0 END + t
    - (coalesce(b1, 0) + coalesce(b2, 0) + coalesce(b3, 0) + coalesce(b4, 0)) AS difference,
    count(*) AS n_rows
  FROM (SELECT list_type, yr, day, adult_child, published_name, {_WIDE_SUMS} FROM base
    WHERE yr >= 2000 GROUP BY ALL) GROUP BY 1"""
    )
)
def band_vs_total(spark, sf_dir):
    wide = clean.parse_counts(tables.published_wide(stores.lines(spark, sf_dir)), [*WIDE_BANDS, "Total"])
    return quality.band_sum_gaps(wide, WIDE_BANDS, "Total")


@query(
    with_unified(
        f"""SELECT hospital_name, CAST(sum(CASE WHEN list_type = 'ipdc' THEN count END) AS BIGINT) AS ipdc_total,
    CAST(sum(CASE WHEN list_type = 'op' THEN count END) AS BIGINT) AS op_total,
    CAST(sum(count) AS BIGINT) AS mixed_total FROM unified WHERE {IN_HOSPITAL} GROUP BY hospital_name"""
    )
)
def contamination(spark, sf_dir):
    rows = eligible(tables.observations(spark, sf_dir), "hospital_name")
    return quality.list_type_contamination(rows, ["hospital_name"])


@query(
    """WITH names AS (
    SELECT p_name || ' Hospital' AS name FROM part UNION
    SELECT split_part(p_name, ' ', 2) || 's University Hospital, ' || upper(split_part(p_name, ' ', 1)) FROM part
  ), keyed AS (
    SELECT name, array_to_string(list_sort(list_filter(
      list_transform(string_split(trim(regexp_replace(lower(name), '[^a-z#0-9]+', ' ', 'g')), ' '),
        lambda w: CASE WHEN length(w) > 3 THEN regexp_replace(w, 's$', '') ELSE w END),
      lambda w: w NOT IN ('general', 'hospital', 'regional', 'the', 'university'))), ' ') AS fingerprint FROM names
  ), grouped AS (
    SELECT fingerprint, count(*) AS n_names, min(name) AS first_name FROM keyed GROUP BY fingerprint
    HAVING count(*) > 1
  )
  SELECT fingerprint, name, first_name, n_names, CAST(levenshtein(name, first_name) AS INTEGER) AS distance
  FROM keyed JOIN grouped USING (fingerprint)"""
)
def alias_candidates(spark, sf_dir):
    """Part names as hospitals, once plain and once reordered, plural and in other case."""
    words = F.split("p_name", " ")
    spellings = F.array(
        F.concat("p_name", F.lit(" Hospital")),
        F.concat(words[1], F.lit("s University Hospital, "), F.upper(words[0])),
    )
    names = tables.table(spark, sf_dir, "part").select(F.explode(spellings).alias("hospital_name"))
    return quality.alias_candidates(names)


@query(
    """WITH names AS (
    SELECT DISTINCT p_name || ' Hospital ' || split_part(p_brand, '#', 2) AS name FROM part
  ), words AS (
    SELECT name, list_distinct(list_filter(string_split(regexp_replace(lower(name), '[^a-z#0-9]+', ' ', 'g'), ' '),
      lambda w: w NOT IN ('', 'general', 'hospital', 'regional', 'the', 'university'))) AS raw FROM names
  ), telling AS (
    SELECT name, list_distinct(list_transform(raw, lambda w: CASE WHEN regexp_matches(w, '[a-z]{3}s$')
      THEN regexp_replace(w, 's$', '') ELSE w END)) AS ws FROM words
  ), each AS (SELECT name, ws, unnest(ws) AS word FROM telling),
  grouped AS (SELECT word, count(*) AS n_names, min(name) AS first_name, arg_min(ws, name) AS first_ws
    FROM each GROUP BY word HAVING count(*) > 1)
  SELECT word, name, first_name, n_names,
    len(list_intersect(ws, first_ws)) / len(list_distinct(list_concat(ws, first_ws))) AS shared
  FROM each JOIN grouped USING (word) WHERE name <> first_name
    AND len(list_intersect(ws, first_ws)) / len(list_distinct(list_concat(ws, first_ws))) >= 0.3"""
)
def alias_candidates_by_word(spark, sf_dir):
    """Part names and brands as hospitals that share a word or two."""
    brand = F.regexp_extract("p_brand", "#(.*)$", 1)
    names = tables.table(spark, sf_dir, "part").select(
        F.concat("p_name", F.lit(" Hospital "), brand).alias("hospital_name")
    )
    return quality.alias_candidates_by_word(names)


@query(
    with_unified(
        """SELECT list_type, source_year_key, count(*) AS n_rows,
    count(*) FILTER (count % 7 = 0) AS n_unknown_population, count(*) FILTER (count % 5 = 0) AS n_undated,
    count(*) FILTER (count % 11 = 0) AS n_uncounted, CAST(0 AS BIGINT) AS n_unknown_list_type
  FROM unified GROUP BY ALL"""
    )
)
def lost_rows(spark, sf_dir):
    """Rows that some answers leave out, where counts of seven, five and eleven are printed wrongly."""
    rows = tables.unified(spark, sf_dir)
    wrong = lambda n, column, value: F.when(F.col("count") % n == 0, value).otherwise(F.col(column))
    faulty = rows.withColumns({
        "adult_child": wrong(7, "adult_child", F.lit("Teenager")),
        "archive_date_parsed": wrong(5, "archive_date_parsed", F.lit(None)),
        "count": wrong(11, "count", F.lit(None)),
    })
    return quality.lost_rows(faulty, ["list_type", "source_year_key"])


@query(
    with_base(
        f"""SELECT strftime(day, '%Y-%m-%d') AS archive_date, list_type, adult_child, hospital_name,
    CASE WHEN b1 BETWEEN 1 AND 29 THEN NULL ELSE b1 END AS months_0_6,
    CASE WHEN b2 BETWEEN 1 AND 29 THEN NULL ELSE b2 END AS months_6_12,
    CASE WHEN b3 BETWEEN 1 AND 29 THEN NULL ELSE b3 END AS months_12_18,
    CASE WHEN b4 BETWEEN 1 AND 29 THEN NULL ELSE b4 END AS months_18_plus,
    CAST((CASE WHEN b1 BETWEEN 1 AND 29 THEN 1 ELSE 0 END) + (CASE WHEN b2 BETWEEN 1 AND 29 THEN 1 ELSE 0 END)
     + (CASE WHEN b3 BETWEEN 1 AND 29 THEN 1 ELSE 0 END) + (CASE WHEN b4 BETWEEN 1 AND 29 THEN 1 ELSE 0 END)
     AS INTEGER) AS n_suppressed
  FROM (SELECT list_type, yr, day, adult_child, published_name AS hospital_name, {_WIDE_SUMS}
    FROM base WHERE yr >= 2000 GROUP BY ALL)"""
    )
)
def small_cell_suppression(spark, sf_dir):
    """Cells below 30 are left empty."""
    wide = clean.wide_table(tables.published_wide(stores.lines(spark, sf_dir)))
    hidden = quality.suppress_small(wide, WIDE_TABLE_COUNTS[:4], minimum=30)
    list_type = F.regexp_extract("dataset", "^([a-z]+)_", 1).alias("list_type")
    return hidden.select(
        "archive_date", list_type, "adult_child", "hospital_name", *WIDE_TABLE_COUNTS[:4], "n_suppressed"
    )


@query(
    with_unified(
        f"""SELECT {iso('archive_date')} AS archive_date, list_type,
    CASE WHEN total < 400 THEN 'Small Volume Hospitals' ELSE hospital_name END AS hospital_name,
    CAST(sum(total) AS BIGINT) AS count
  FROM (SELECT hospital_name, archive_date, list_type, sum(count) AS total FROM unified
    WHERE {IN_HOSPITAL} GROUP BY ALL) GROUP BY ALL"""
    )
)
def bucket_small(spark, sf_dir):
    """Hospitals with fewer than 400 people are added up under one label."""
    rows = eligible(tables.observations(spark, sf_dir), "hospital_name")
    return quality.bucket_small(
        rows, "hospital_name", ["archive_date", "list_type"], SUPPRESSED_HOSPITAL_LABEL, 400
    )


# ---- governance: one record per customer, some with faults ------------------------------------------


def _records(spark, sf_dir):
    key = F.col("c_custkey")
    level = F.when(key % 11 == 0, "planet").otherwise("hospital")
    constants = {
        name: F.lit("x")
        for name in METADATA_REQUIRED
        if name not in ("dataset_id", "licence", "variables", "geography_level")
    }
    fields = {
        **constants,
        "dataset_id": F.concat(
            F.lit("dataset-"), key.cast("string"), F.when(key % 13 == 0, " A").otherwise("")
        ),
        "licence": F.when(key % 5 != 0, "open"),
        "variables": F.when(key % 17 != 0, F.array(F.lit("a"), F.lit("b"))).otherwise(
            F.array().cast("array<string>")
        ),
        "geography_level": level,
        "redistribution_allowed": F.lit(True),
        "small_cell_suppression_applied": key % 2 == 0,
        "download_date": F.when(key % 19 == 0, "2026-02-30").otherwise("2026-02-28"),
        "processing_date": F.lit("2026-03-01"),
        "colour": F.when(key % 7 == 0, "green"),
    }
    # A record costs far more than its customer's row in a file, so that a small file is spread over all cores.
    keys = tables.table(spark, sf_dir, "customer").select(key).repartition(spark.sparkContext.defaultParallelism, key)
    return keys.select(
        key, F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("record")
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'licence' ELSE '' END AS missing,
    CASE WHEN c_custkey % 7 = 0 THEN 'colour' ELSE '' END AS undeclared,
    concat_ws(',', CASE WHEN c_custkey % 13 = 0 THEN 'dataset_id' END,
      CASE WHEN c_custkey % 11 = 0 THEN 'geography_level' END,
      CASE WHEN c_custkey % 17 = 0 THEN 'variables' END,
      CASE WHEN c_custkey % 19 = 0 THEN 'download_date' END) AS out_of_rule,
    c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AS is_complete FROM customer"""
)
def metadata_check(spark, sf_dir):
    checked = governance.check_metadata(_records(spark, sf_dir))
    return checked.select(
        "c_custkey",
        F.concat_ws(",", "missing").alias("missing"),
        F.concat_ws(",", "undeclared").alias("undeclared"),
        F.concat_ws(",", "out_of_rule").alias("out_of_rule"),
        "is_complete",
    )


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 41 = 0 THEN 'not a record' ELSE concat_ws(',',
      CASE WHEN c_custkey % 7 = 0 THEN 'colour/undeclared' END,
      CASE WHEN c_custkey % 13 = 0 THEN 'dataset_id/pattern' END,
      CASE WHEN c_custkey % 19 = 0 THEN 'download_date/format' END,
      CASE WHEN c_custkey % 11 = 0 THEN 'geography_level/enum' END,
      CASE WHEN c_custkey % 5 = 0 THEN 'licence/required' END,
      CASE WHEN c_custkey % 29 = 0 THEN 'redistribution_allowed/type' END,
      CASE WHEN c_custkey % 3 <> 0 THEN 'source_url/format' END,
      CASE WHEN c_custkey % 23 = 0 AND c_custkey % 17 <> 0 THEN 'variables/items/type' END,
      CASE WHEN c_custkey % 17 = 0 THEN 'variables/minItems' END) END AS violations FROM customer"""
)
def metadata_rules(spark, sf_dir):
    """Every rule of the declared record schema, with records that break it."""
    key, record = F.col("c_custkey"), F.col("record")
    for every, text, other in (
        (3, '"source_url":"x"', '"source_url":"https://example.org/a?b=c"'),
        (23, '["a","b"]', '["a",1]'),
        (29, '"redistribution_allowed":true', '"redistribution_allowed":"yes"'),
        (41, "}", ""),
    ):
        record = F.when(key % every == 0, F.replace(record, F.lit(text), F.lit(other))).otherwise(record)
    checked = record_schema.check_schema(_records(spark, sf_dir).withColumn("record", record))
    return checked.select("c_custkey", F.concat_ws(",", "violations").alias("violations"))


@query(
    """SELECT 'customer' AS dataset_id, 'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' AS variables,
    (SELECT bool_or(contains(lower(c_mktsegment), 'furniture')) FROM customer) AS small_cell_suppression_applied,
    strftime(current_date, '%Y-%m-%d') AS download_date"""
)
def metadata_record(spark, sf_dir):
    """A record whose variables and suppression flag are read off the table."""
    rows = tables.table(spark, sf_dir, "customer")
    position = F.array_position(F.array(*[F.lit(c) for c in rows.columns]), F.col("column_name"))
    profile = quality.column_profile(rows).withColumn("position", position)
    scanned = profile.join(quality.marker_scan(rows, ("furniture",)), "column_name")
    made = governance.metadata_record(scanned, {"dataset_id": "customer"}, F.bool_or("found"))
    return made.select(
        "dataset_id",
        F.concat_ws(",", "variables").alias("variables"),
        "small_cell_suppression_applied",
        "download_date",
    )


@query(
    """SELECT c_name AS dataset_id, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'old'
    WHEN c_acctbal > 5000 THEN 'earlier' ELSE 'new' END AS added
  FROM customer WHERE c_mktsegment = 'FURNITURE' OR c_acctbal > 0"""
)
def register_append(spark, sf_dir):
    """Entries are added to the register unless their dataset is in it already; of two that differ the
    one that was added first."""
    rows = tables.table(spark, sf_dir, "customer")
    name = F.col("c_name").alias("dataset_id")
    register = rows.where("c_mktsegment = 'FURNITURE'").select(name, F.lit("old").alias("added"))
    entries = rows.where("c_acctbal > 0").select(name, F.lit("new").alias("added"))
    conflicting = rows.where("c_acctbal > 5000").select(name, F.lit("earlier").alias("added"))
    return joins.append_missing(register, entries.unionByName(conflicting).unionByName(entries))


@query(
    """SELECT c_name AS dataset_id, CAST(2 AS BIGINT) AS n_entries FROM customer WHERE c_acctbal > 5000"""
)
def register_conflicts(spark, sf_dir):
    """Datasets listed with entries that differ."""
    rows = tables.table(spark, sf_dir, "customer").withColumnRenamed("c_name", "dataset_id")
    entries = rows.where("c_acctbal > 0").select("dataset_id", F.lit("new").alias("added"))
    earlier = rows.where("c_acctbal > 5000").select("dataset_id", F.lit("earlier").alias("added"))
    return joins.conflicting_entries(entries.unionByName(earlier).unionByName(entries))


_REGISTERED = "c_mktsegment <> 'FURNITURE'"
_COMPLETE = "(c_custkey % 5 <> 0 AND c_custkey % 7 <> 0)"


@query(
    f"""SELECT c_custkey, {_COMPLETE} AND {_REGISTERED} AS allowed, {_COMPLETE} AS has_record,
    {_REGISTERED} AS has_row FROM customer"""
)
def publish_gate(spark, sf_dir):
    """Datasets with a complete record and a register row; the others with what they lack."""
    customers = tables.table(spark, sf_dir, "customer")
    datasets = customers.select("c_custkey")
    checked = governance.check_metadata(_records(spark, sf_dir))
    register = customers.where(_REGISTERED).select("c_custkey")
    allowed, held = governance.publishable(datasets, checked, register, key="c_custkey")
    yes, no = F.lit(True), F.lit(False)
    return allowed.select(
        "c_custkey", yes.alias("allowed"), yes.alias("has_record"), yes.alias("has_row")
    ).unionByName(
        held.select(
            "c_custkey",
            no.alias("allowed"),
            F.col("has_complete_record").alias("has_record"),
            F.col("has_register_row").alias("has_row"),
        )
    )


@query(
    """WITH needs AS (
    SELECT DISTINCT o_orderkey, d FROM orders CROSS JOIN LATERAL (VALUES (o_custkey), (o_custkey + 1)) AS v(d)
    WHERE o_orderstatus <> 'P'
  )
  SELECT o_orderkey AS indicator_id, count(d) AS n_needed,
    count(d) FILTER (d IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'FURNITURE')) AS n_available,
    coalesce(bool_and(d IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'FURNITURE')), true) AS is_ready
  FROM orders LEFT JOIN needs USING (o_orderkey) GROUP BY o_orderkey"""
)
def indicator_ready(spark, sf_dir):
    """Each order as an indicator that needs two customers' datasets; pending ones need none."""
    customer = F.col("o_custkey")
    two = F.array(customer.cast("string"), (customer + 1).cast("string"))
    indicators = tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("indicator_id"),
        F.when(F.col("o_orderstatus") != "P", two).alias("depends_on"),
    )
    available = tables.table(spark, sf_dir, "customer").where(_REGISTERED)
    return governance.ready_indicators(
        indicators, available.select(F.col("c_custkey").cast("string").alias("dataset_id"))
    )
