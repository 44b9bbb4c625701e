"""Landed files: `<landing>/dataset=D/year_key=Y/published=P/*.csv`.

A publication is a folder of one or more CSV files and is never edited. A corrected publication of
the same year lands in a folder with a later `published` value, and the latest valid one counts.
"""

from __future__ import annotations

from collections import defaultdict
from multiprocessing.pool import ThreadPool

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..fixed_values import LONG, LONG_EARLY, WIDE, WIDE_SPECIALTY
from ..functions.cells import present
from ..functions.headers import clean_headers, family_of_header
from ..schemas import text_schema
from .catalogue import family_of, source_url_of
from .file_hashes import hash_files

# Early and later long files differ in names only, which are merged when they are harmonised.
SHAPE_OF_FAMILY = {WIDE: "wide", WIDE_SPECIALTY: "specialty", LONG: "long", LONG_EARLY: "long"}

FOLDER_KEYS = ("dataset", "year_key", "published")
_KEY_FIELDS = [StructField(name, StringType()) for name in FOLDER_KEYS]
BAD_ROW = "_bad_row"

# Why a publication was left out.
UNKNOWN, MISFIT, EMPTY, BAD_ROWS = "unknown dataset or year", "header does not fit", "no rows", "bad rows"
REJECTS = "dataset string, year_key string, published string, folder string, reason string, detail string"

FOLDER = "regexp_extract(path, '^(.*)/[^/]+$', 1)"


def list_files(spark: SparkSession, landing: str) -> DataFrame:
    """Landed files without their content; only the file listing is read. Spark lists no file without a byte."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(landing)
    return files.select(
        "path",
        F.expr(FOLDER).alias("folder"),
        "length",
        "modificationTime",
        *[F.col(name).cast("string").alias(name) for name in FOLDER_KEYS],
    )


def hashed(rows: DataFrame, content: str) -> DataFrame:
    """`rows` with the SHA-256 of a text or binary column in its place."""
    kept = [F.col(f"`{name}`") for name in rows.columns if name != content]
    return rows.select(*kept, F.sha2(F.col(f"`{content}`").cast("binary"), 256).alias("sha256"))


def manifest(spark: SparkSession, landing: str) -> DataFrame:
    """Landed files with the SHA-256 of their bytes, read in steps whatever their size. A file that could not be
    read has no hash but an `error`, and keeps no other from having one."""
    return hash_files(list_files(spark, landing).drop("folder"))


def unreadable_files(entries: DataFrame) -> DataFrame:
    """The files of a manifest that could not be hashed, each with the reason."""
    return entries.where("error is not null").select(*FOLDER_KEYS, "path", "error")


def duplicate_files(entries: DataFrame) -> DataFrame:
    """Byte-identical files of a manifest: how often each content was landed."""
    return (
        entries.where("sha256 is not null").groupBy("sha256")
        .agg(F.count("*").alias("copies"), F.min("path").alias("first_path"))
        .where("copies > 1")
    )


def latest_publications(files: DataFrame) -> DataFrame:
    """The folder that counts for each (dataset, year_key)."""
    return files.groupBy("dataset", "year_key").agg(
        F.max("published").alias("published"), F.max_by("folder", "published").alias("folder")
    )


def publications(files: DataFrame) -> DataFrame:
    """Every publication: its folder, and how many files and bytes lie there."""
    return files.groupBy("dataset", "year_key", "published", "folder").agg(
        F.count("*").alias("n_files"), F.sum("length").alias("bytes")
    )


def dispatch(publications: DataFrame, **families) -> tuple[DataFrame, DataFrame]:
    """(publications with their shape family, those of an unknown dataset or year)."""
    family = family_of(F.col("dataset"), F.col("year_key"), **families)
    placed = publications.withColumn("family", family)
    return placed.where("family is not null"), placed.where("family is null").drop("family")


def read_header(spark: SparkSession, folder: str) -> list[str]:
    """Column names of a publication's first file. Spark reads the first line of one file for this."""
    return spark.read.option("header", True).option("escape", '"').csv(folder).columns


def _text_rows(
    spark: SparkSession, landing: str, folders: list[str], header: list[str], multi_line: bool
) -> DataFrame:
    """One scan over all folders whose files share a header, with BAD_ROW set on rows that do not fit it.

    Spark checks the header of each file it opens, so that one with other columns, or another order,
    fails the load rather than being read into the wrong columns. Columns are not pruned in the parser,
    which would otherwise not see how many cells a row has.
    """
    schema = StructType([*text_schema([*header, BAD_ROW]).fields, *_KEY_FIELDS])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .option("multiLine", multi_line)
        .option("basePath", landing)
        .csv(folders)
    )


def read_csv(
    spark: SparkSession, landing: str, folders: list[str], header: list[str], multi_line: bool = False
) -> DataFrame:
    """The fitting rows of all folders whose files share a header. Every cell is text.

    A row with more or fewer cells than the header is not read; `row_counts` says how many there are.
    Line breaks inside quotes need `multi_line`, with which a file is read by one task.
    """
    return _fitting(_text_rows(spark, landing, folders, header, multi_line), header)


def _fitting(cells: DataFrame, header: list[str]) -> DataFrame:
    names = clean_headers(header)
    return cells.where(F.col(BAD_ROW).isNull()).select(
        *[present(cells[raw]).alias(name) for raw, name in zip(header, names)],
        *FOLDER_KEYS,
        F.col("_metadata.file_path").alias("_source_file"),
    )


def row_counts(
    spark: SparkSession, landing: str, folders: list[str], header: list[str], multi_line: bool = False
) -> DataFrame:
    """(dataset, year_key, n_rows, n_bad, n_unkeyed) of each publication; one without rows is absent.

    `n_unkeyed` counts rows without a first cell. Spark asks for a column beside the one of bad rows.
    """
    cells = _text_rows(spark, landing, folders, header, multi_line)
    return cells.groupBy("dataset", "year_key").agg(
        F.count("*").alias("n_rows"),
        F.count(BAD_ROW).alias("n_bad"),
        F.count_if(cells[header[0]].isNull()).alias("n_unkeyed"),
    )


def with_lineage(rows: DataFrame) -> DataFrame:
    """Where each row comes from and when it was loaded."""
    return rows.withColumns(
        {
            "_source_year_key": F.col("year_key"),
            "_source_url": source_url_of(F.col("dataset"), F.col("year_key")),
            "_loaded_date": F.current_date(),
        }
    )


def _layouts(
    spark: SparkSession, found: list[Row]
) -> tuple[dict[tuple[str, tuple[str, ...]], list[Row]], list[Row]]:
    """({(family, header): publications}, rejects whose header does not fit their year)."""
    with ThreadPool(8) as pool:  # each is a job of one short task
        headers = pool.map(lambda row: read_header(spark, row.folder), found)
    layouts, misfits = defaultdict(list), []
    for row, header in zip(found, headers):
        if SHAPE_OF_FAMILY.get(family_of_header(clean_headers(header))) == SHAPE_OF_FAMILY[row.family]:
            layouts[row.family, tuple(header)].append(row)
        else:
            misfits.append(_reject(row, MISFIT, ", ".join(header)))
    return layouts, misfits


def _reject(row: Row, reason: str, detail: str | None = None) -> tuple:
    return (row.dataset, row.year_key, row.published, row.folder, reason, detail)


def _judged(
    rows: list[Row], counts: dict, allow_bad_rows: bool
) -> tuple[list[Row], list[tuple]]:
    """(publications to load, rejects for what their rows are like)."""
    fine, rejects = [], []
    for row in rows:
        n_rows, n_bad = counts.get((row.dataset, row.year_key), (0, 0))
        if n_rows == 0:
            rejects.append(_reject(row, EMPTY))
        elif n_bad and (not allow_bad_rows or n_bad == n_rows):
            rejects.append(_reject(row, BAD_ROWS, f"{n_bad} of {n_rows} rows"))
        else:
            fine.append(row)
    return fine, rejects


def read_publications(
    spark: SparkSession,
    landing: str,
    publications: DataFrame,
    allow_bad_rows: bool = False,
    multi_line: bool = False,
) -> tuple[list[tuple[str, DataFrame]], list[tuple]]:
    """([(family, rows)], rejects): one scan per family and distinct header, and what cannot be loaded.

    A publication is rejected whole if its header does not fit its year, if it has no rows, or if a row
    has more or fewer cells than the header, unless `allow_bad_rows`, which leaves out such rows only.
    Rows are counted in a scan of their own, before anything is loaded. Rejects are rows of REJECTS.

    `publications` has one row per dataset and year, so what reaches the driver here are folder names,
    headers and counts, as many as the catalogue has entries.
    """
    found = publications.orderBy("dataset", "year_key").collect()
    layouts, rejects = _layouts(spark, found)

    def judge(item):
        (_, header), rows = item
        folders = [row.folder for row in rows]
        try:
            counted = row_counts(spark, landing, folders, list(header), multi_line).collect()
        except (PySparkException, Py4JJavaError) as error:
            if not _misfit(error):
                raise
            if len(rows) == 1:
                return [], [_reject(rows[0], MISFIT, "files with different headers")]
            alone = [judge(((None, header), [row])) for row in rows]
            return [r for fine, _ in alone for r in fine], [r for _, bad in alone for r in bad]
        counts = {(r.dataset, r.year_key): (r.n_rows, r.n_bad) for r in counted}
        return _judged(rows, counts, allow_bad_rows)

    with ThreadPool(max(1, len(layouts))) as pool:
        judged = pool.map(judge, layouts.items())
    scans = []
    for (family, header), (fine, bad) in zip(layouts, judged):
        rejects += bad
        if fine:
            folders = [row.folder for row in fine]
            scans.append((family, read_csv(spark, landing, folders, list(header), multi_line)))
    return scans, rejects


def _misfit(error: Exception) -> bool:
    """Whether a file's header is another than the one its folder is read with."""
    return "CSV header does not conform" in str(error)


def stage_publications(
    spark: SparkSession,
    landing: str,
    found: list[Row],
    staging: str,
    allow_bad_rows: bool = False,
    multi_line: bool = False,
) -> tuple[list[tuple[Row, str, int]], list[tuple]]:
    """([(publication, staged folder, rows)], rejects): each publication's fitting rows below `staging`.

    Every file is read once, by one scan per family and distinct header. The scan observes how many rows do not
    fit while the others are written, and rows are counted from what was written. Only if some
    do not fit does another scan say whose they are. What is judged and how is said at `read_publications`.

    `found` has one row per dataset and year.
    """
    layouts, rejects = _layouts(spark, found)

    def stage(rows: list[Row], header: list[str], at: str):
        folders, seen = [row.folder for row in rows], Observation()
        cells = _text_rows(spark, landing, folders, header, multi_line).observe(seen, F.count(BAD_ROW).alias("n_bad"))
        try:
            staged = with_lineage(_fitting(cells, header)).drop("published")
            staged.write.partitionBy("dataset", "year_key").parquet(at)
        except (PySparkException, Py4JJavaError) as error:
            if not _misfit(error):
                raise
            if len(rows) == 1:
                return [], [_reject(rows[0], MISFIT, "files with different headers")]
            alone = [stage([row], header, f"{at}-{i}") for i, row in enumerate(rows)]
            return [x for fine, _ in alone for x in fine], [x for _, bad in alone for x in bad]
        # No column is read, only how many rows each file has.
        written = spark.read.schema("dataset string, year_key string").parquet(at).groupBy("dataset", "year_key").count()
        counts = {(r.dataset, r.year_key): (r["count"], 0) for r in written.collect()}
        fitting = {key: n for key, (n, _) in counts.items()}
        if seen.get["n_bad"]:
            counted = row_counts(spark, landing, folders, header, multi_line).collect()
            counts = {(r.dataset, r.year_key): (r.n_rows, r.n_bad) for r in counted}
        fine, bad = _judged(rows, counts, allow_bad_rows)
        place = lambda r: f"{at}/dataset={r.dataset}/year_key={r.year_key}"
        return [(row, place(row), fitting[row.dataset, row.year_key]) for row in fine], bad

    with ThreadPool(max(1, len(layouts))) as pool:
        work = [(rows, list(header), f"{staging}/{i}") for i, ((_, header), rows) in enumerate(layouts.items())]
        done = pool.starmap(stage, work)
    return [x for fine, _ in done for x in fine], rejects + [x for _, bad in done for x in bad]
