"""The watch folder as a stream: new files are landed once, in micro-batches, by the same functions as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from portflow.operators import stored
from portflow.sources.folders import shared_dir
from portflow.sources.registry import SourceSpec, source
from portflow.sources.reports import INPUT, ingest_files, numbers_in_names
from portflow.sources.store import Store
from portflow.specs import FactSpec, LoadType

LOADS = "load_id long, source_name string, date_loaded timestamp, load_type_id int, load_status_id int"
ERRORS = "error_message string, error_procedure string, error_datetime timestamp"
_FILES = "path string, modificationTime timestamp, length long, content binary"


#: The one table of a log, and the stream that numbers its batches.
ROWS, STREAM = "rows", "batch"


def logged(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a log; none if there is no log yet."""
    return Store(spark, path).read(ROWS, schema)


def log(spark: SparkSession, path: str, rows: DataFrame, schema: str, batch: int) -> bool:
    """A batch's rows, once; entries that have gathered are merged, so that a log of many batches stays a log of few folders."""
    store = Store(spark, path)
    if store.manifest().has(STREAM, batch):
        return False
    done = store.publish([store.stage(ROWS, rows)], STREAM, batch)
    store.merge_tiers(ROWS, schema)
    return done


def watch(spark: SparkSession, folder: str, home: str, checkpoint: str, spec: SourceSpec | None = None) -> StreamingQuery:
    """Lands what is new and stops: rows in home/raw, ledger rows in home/loads, error rows in home/errors.

    The stream is one of files, of which only the paths are read; each micro-batch reads its files by their own headers. The
    stream's checkpoint knows the files it has seen, and the ledger their names: a name that has not failed is not loaded again.
    The load id is the number in the file's name. Errors are logged first, the ledger last; a batch that is tried again overwrites its own loads
    and adds nothing to a log that has it. Files with hidden names (`_`, `.`) are no part of a stream; a folder's ingest takes them.
    """
    spec = spec or source(LoadType.VESSEL_REPORT)
    shared_dir(spark)

    def batch(files: DataFrame, n: int) -> None:
        if Store(spark, f"{home}/loads").manifest().has(STREAM, n):
            return
        found = {r["path"].rsplit("/", 1)[1]: r["path"] for r in files.select("path").collect()}  # one path per file
        found = {n: p for n, p in found.items() if INPUT.fullmatch(n)}
        loads = logged(spark, f"{home}/loads", LOADS)
        _, new, errors = ingest_files(spark, dict(sorted(found.items())), f"{home}/raw", loads, spec, numbers_in_names)
        log(spark, f"{home}/errors", errors, ERRORS, n)
        log(spark, f"{home}/loads", new, LOADS, n)

    files = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*.[cC][sS][vV]").load(folder).select("path")
    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_versions(rows: DataFrame, spec: FactSpec, path: str, checkpoint: str) -> StreamingQuery:
    """A stream of fact rows kept as a log of versions: each micro-batch adds its own, and tiers of batches are merged.

    `versions.current` and `versions.history` of the log are the state, whatever the order in which batches came.
    """
    spark = rows.sparkSession

    def batch(new: DataFrame, n: int) -> None:
        stored.append_versions(Store(spark, path), ROWS, new, spec, STREAM, n)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
