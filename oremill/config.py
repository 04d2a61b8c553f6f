"""Settings that vary by environment, and the description of one ingest task."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Row


@dataclass(frozen=True)
class Environment:
    """Where the layers live and how far back an incremental refresh reaches."""

    name: str
    root: str
    incremental_days: int = 1
    # Bounds one step of the file ingest; None takes all new files at once.
    files_per_batch: int | None = None
    # The landed files' marker of NULL; without one an empty field is NULL.
    null_value: str | None = None
    # Folders that a stored table is dealt into by its key: about one for each file that it should have.
    buckets: int = 16

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def checkpoints(self) -> str:
        return f"{self.root}/checkpoints"


# Days re-computed by an incremental refresh, per environment.
INCREMENTAL_DAYS = {"dev": 1, "uat": 3, "prod": 7}


def environment(name: str, root: str) -> Environment:
    key = name.strip().lower()
    if key not in INCREMENTAL_DAYS:
        raise ValueError(f"unknown environment {name!r}; expected one of {sorted(INCREMENTAL_DAYS)}")
    return Environment(key, root.rstrip("/"), INCREMENTAL_DAYS[key])


def is_yes(flag: str | None) -> bool:
    return flag is not None and flag.strip().upper() == "Y"


@dataclass(frozen=True)
class IngestSpec:
    """One file-ingest task: where the files are, how to read them, where and how to load them."""

    job_name: str
    task_name: str
    source_path: str
    target_path: str
    grouping_id: str = ""
    file_format: str = "csv"
    header: bool = True
    delimiter: str = ","
    load_type: str = "APPEND"
    skip_rows: int | None = None
    all_files: bool = True
    latest_only: bool = False
    options: dict[str, str] = field(default_factory=dict)
    null_value: str | None = None

    @staticmethod
    def from_metadata(row: Row, root: str) -> "IngestSpec":
        """Build the spec from one row of the ingest metadata table; paths are relative to ``root``."""
        return IngestSpec(
            job_name=row["job_name"],
            task_name=row["task_name"],
            grouping_id=row["grouping_id"] or "",
            source_path=f"{root}/{row['source_adls_path']}",
            target_path=f"{root}/{row['target_schema']}/{row['target_table']}",
            file_format=row["source_file_extension"],
            header=row["source_file_header"] == "Y",
            delimiter=row["source_file_delimiter"] or ",",
            load_type=row["load_type"] or "None",
            skip_rows=row["skip_rows"],
            all_files=is_yes(row["ingest_all_files_from_adls"]),
            latest_only=row["ingest_latest_files_from_adls"] == "Y",
        )
