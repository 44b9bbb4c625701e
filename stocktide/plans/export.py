"""Writing everything that is published from a warehouse."""

from __future__ import annotations

from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import DATASET_LIST_TYPE, NATIONAL_SPECIALTY
from ..operators.star import Star
from ..sources.catalogue import HOSPITAL_DATASETS
from ..sources.documents import LINES, write_documents, write_lines
from ..sources.published_documents import publish_documents
from .publish import (
    star_hospital_documents,
    star_index,
    star_national_document,
    star_specialty_document,
)

NATIONAL, BY_SPECIALTY, HOSPITALS, INDEX = "national", "national_by_specialty", "hospitals", "index"


def export(star: Star, folder: str, layout: str = LINES) -> None:
    """National document, specialty rankings, a document per hospital, and their index by name.

    Each hospital, list type and population comes from one aggregation over the facts, not a query
    each.
    """
    writes = (
        lambda: write_lines(star_national_document(star), f"{folder}/{NATIONAL}"),
        lambda: write_lines(star_specialty_document(star), f"{folder}/{BY_SPECIALTY}"),
        lambda: write_documents(star_hospital_documents(star), f"{folder}/{HOSPITALS}", layout),
        lambda: write_lines(star_index(star), f"{folder}/{INDEX}"),
    )
    with ThreadPool(len(writes)) as pool:  # their jobs do not depend on each other
        pool.map(lambda write: write(), writes)


def dataset_id(dataset: str) -> str:
    """The id that a catalogued dataset has in metadata records and the register, which know no underscores."""
    return dataset.replace("_", "-")


def of_datasets(star: Star, allowed: DataFrame, key: str = "dataset_id") -> Star:
    """The star schema with the facts of the datasets in `allowed`, such as those that pass the publish gate.

    List types, by which facts are partitioned, are left out by the scan if none of their datasets is allowed.
    """
    ids = {dataset_id(name): name for name in DATASET_LIST_TYPE}
    # The catalogue's few datasets at most.
    found = {ids[row[0]] for row in allowed.where(F.col(key).isin(*ids)).select(key).distinct().collect()}
    condition = F.lit(False)
    for name in sorted(found):
        national = F.col("granularity") == NATIONAL_SPECIALTY
        cut = ~national if name in HOSPITAL_DATASETS else national
        condition = condition | ((F.col("list_type") == DATASET_LIST_TYPE[name]) & cut)
    return replace(star, fact=star.fact.where(condition))


def export_changed(
    star: Star, folder: str, allowed: DataFrame | None = None, minimum: int | None = None
) -> dict[str, int]:
    """Publish what `export` writes, by content: only documents that changed are written.

    With `allowed` (dataset_id) no document shows a dataset that is not in it. With a `minimum`, cells from 1 to below it
    are null, and with any of them their point's total; sums over hospitals are not hidden for the sake of one
    hospital's cell. Returns the documents written of each kind. `published_documents.read_published` reads them.
    """
    shown = star if allowed is None else of_datasets(star, allowed)
    kinds = {
        NATIONAL: star_national_document(shown, minimum=minimum),
        BY_SPECIALTY: star_specialty_document(shown, minimum=minimum),
        HOSPITALS: star_hospital_documents(shown, minimum=minimum),
        INDEX: star_index(shown),
    }
    return publish_documents(star.fact.sparkSession, folder, kinds)
