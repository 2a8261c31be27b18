"""Fixed schemas of the metadata tables and the projection onto them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOLEAN, TIMESTAMP = T.DoubleType(), T.BooleanType(), T.TimestampType()
STRINGS = T.ArrayType(STRING)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in fields.items()])


QUESTIONS = _struct(
    id=STRING, db_id=STRING, question=STRING, evidence=STRING, sql_query=STRING,
    difficulty=STRING, domain=STRING, question_id_original=STRING, created_at=TIMESTAMP,
)
DATABASES = _struct(
    db_id=STRING, db_name=STRING, domain=STRING, num_tables=LONG, description=STRING,
    size_mb=DOUBLE, sqlite_path=STRING, created_at=TIMESTAMP,
)
TABLES = _struct(
    id=STRING, db_id=STRING, table_name=STRING, column_names=STRINGS,
    column_types=STRINGS, primary_keys=STRINGS,
    foreign_keys=T.ArrayType(_struct(source_column=STRING, target_table=STRING, target_column=STRING)),
    created_at=TIMESTAMP,
)
TABLE_SCHEMAS = _struct(
    id=STRING, db_id=STRING, table_name=STRING, column_name=STRING, column_type=STRING,
    is_primary_key=BOOLEAN, is_foreign_key=BOOLEAN, foreign_table=STRING,
    foreign_column=STRING, column_position=INT, created_at=TIMESTAMP,
)
FOREIGN_KEYS = _struct(
    id=STRING, db_id=STRING, source_table=STRING, source_column=STRING,
    target_table=STRING, target_column=STRING, created_at=TIMESTAMP,
)
TABLE_DATA_INFO = _struct(
    db_id=STRING, table_name=STRING, row_count=LONG, data_loaded=BOOLEAN,
    target_table_name=STRING, load_timestamp=TIMESTAMP, created_at=TIMESTAMP,
)
EXECUTION_RESULTS = _struct(
    question_id=STRING, execution_time_ms=DOUBLE, result_rows=LONG,
    execution_success=BOOLEAN, error_message=STRING, created_at=TIMESTAMP,
)
TEST_SUMMARY = _struct(
    domain=STRING, question_count=LONG, avg_question_length=DOUBLE, created_at=TIMESTAMP,
)
LOAD_LOG = _struct(
    db_id=STRING, table_name=STRING, target_table_name=STRING, row_count=LONG,
    cast_failures=LONG, signature=STRING, ok=BOOLEAN, error=STRING, load_timestamp=TIMESTAMP,
)

METADATA_TABLES = {
    "questions": QUESTIONS,
    "databases": DATABASES,
    "tables": TABLES,
    "table_schemas": TABLE_SCHEMAS,
    "foreign_keys": FOREIGN_KEYS,
    "table_data_info": TABLE_DATA_INFO,
    "execution_results": EXECUTION_RESULTS,
    "test_summary": TEST_SUMMARY,
}

PRIMARY_KEYS = {
    "questions": ["id"],
    "databases": ["db_id"],
    "tables": ["id"],
    "table_schemas": ["id"],
    "foreign_keys": ["id"],
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project `df` onto `schema`: its order and types, absent columns null.

    `created_at` defaults to the current timestamp where `df` does not bring it.
    """
    have = set(df.columns)
    columns = []
    for field in schema.fields:
        if field.name in have:
            column = F.col(field.name)
        elif field.name == "created_at":
            column = F.current_timestamp()
        else:
            column = F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
