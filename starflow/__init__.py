"""Flat, dirty sales extracts to a star schema, as Spark DataFrame operators."""

from starflow.operators.cleaning import (
    CleaningSpec,
    clean,
    clean_numbers,
    cleaning_metrics,
    drop_duplicate_rows,
    drop_duplicate_rows_late,
    impute,
    invalid_number_counts,
    trim_columns,
)
from starflow.operators.dimensions import (
    DimensionSpec,
    DuplicateKeyError,
    build_dimension,
    check_unique,
    duplicate_keys,
    require_unique,
)
from starflow.operators.facts import FactSpec, attach_keys, build_fact, unmatched_keys
from starflow.operators.features import (
    FeatureSpec,
    add_calendar,
    add_risk_flag,
    add_sales_rank,
    add_unit_price,
    enrich,
    feature_catalog,
)
from starflow.operators.history import HistorySpec, attach_as_of, build_history
from starflow.operators.profiles import merge_states, null_trend, profile_state, read_profile
from starflow.operators.quality import (
    QualityError,
    duplicate_row_count,
    null_profile,
    quality_report,
    require_quality,
    row_count,
)
from starflow.operators.rank import dense_rank_in_group, top_in_group
from starflow.operators.registry import keyed_by_registry, new_keys
from starflow.plans.incremental import ChangedFileError, SalesStore
from starflow.plans.sales import (
    MissingValueError,
    SalesRun,
    SalesSpec,
    run_sales,
    run_sales_files,
    sales_spec,
)
from starflow.plans.star import StarSpec, attach_dimensions, build_star, join_star, table_counts
from starflow.sources.cells import bad_cell_counts, scan_cells
from starflow.sources.commits import ConcurrentCommitError, TableSet
from starflow.sources.contract import (
    SchemaContract,
    column_names,
    missing_required,
    normalize_columns,
    sales_contract,
)
from starflow.sources.files import (
    EmptySourceError,
    files_by_header,
    read_contract,
    read_parquet,
    scan_csv,
    scan_csv_by_header,
)
from starflow.sources.tables import UnwritableTextError, read_table, write_tables
from starflow.sources.workspace import Workspace

__all__ = [name for name in dir() if not name.startswith("_")]
