"""J1 canonicalize and E23 categorize: a left equi-join to a small constant lookup.

The default lookup is the constant table below (73 keys), so its size is fixed and known and it is broadcast; a caller-supplied lookup
is broadcast only after its planned size is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import _c, title_case
from ..session import broadcast_if_small

# Fixed values that must equal the reference's for right results: every lookup key and its canonical name.
SKILL_LOOKUP = (
    ("agile", "Agile"),
    ("airflow", "Airflow"),
    ("amazon web services", "AWS"),
    ("aws", "AWS"),
    ("azure", "Azure"),
    ("bigquery", "BigQuery"),
    ("c", "C"),
    ("c++", "C++"),
    ("ci/cd", "CI/CD"),
    ("cicd", "CI/CD"),
    ("computer vision", "Computer Vision"),
    ("cv", "Computer Vision"),
    ("data analysis", "Data Analysis"),
    ("data engineering", "Data Engineering"),
    ("data visualization", "Data Visualization"),
    ("databricks", "Databricks"),
    ("dbt", "dbt"),
    ("deep learning", "Deep Learning"),
    ("django", "Django"),
    ("dl", "Deep Learning"),
    ("docker", "Docker"),
    ("duckdb", "DuckDB"),
    ("excel", "Excel"),
    ("fastapi", "FastAPI"),
    ("flask", "Flask"),
    ("gcp", "GCP"),
    ("git", "Git"),
    ("go", "Go"),
    ("google cloud", "GCP"),
    ("hadoop", "Hadoop"),
    ("java", "Java"),
    ("javascript", "JavaScript"),
    ("kafka", "Kafka"),
    ("kubernetes", "Kubernetes"),
    ("linux", "Linux"),
    ("machine learning", "Machine Learning"),
    ("microsoft azure", "Azure"),
    ("ml", "Machine Learning"),
    ("mlflow", "MLflow"),
    ("mongodb", "MongoDB"),
    ("mysql", "MySQL"),
    ("natural language processing", "Natural Language Processing"),
    ("nlp", "Natural Language Processing"),
    ("numpy", "NumPy"),
    ("pandas", "Pandas"),
    ("postgres", "PostgreSQL"),
    ("postgresql", "PostgreSQL"),
    ("power bi", "Power BI"),
    ("powerbi", "Power BI"),
    ("python", "Python"),
    ("pytorch", "PyTorch"),
    ("r", "R"),
    ("react", "React"),
    ("redis", "Redis"),
    ("rust", "Rust"),
    ("scala", "Scala"),
    ("scikit learn", "Scikit-Learn"),
    ("scikit-learn", "Scikit-Learn"),
    ("scikitlearn", "Scikit-Learn"),
    ("scrum", "Scrum"),
    ("shiny", "Shiny"),
    ("sklearn", "Scikit-Learn"),
    ("snowflake", "Snowflake"),
    ("spark", "Spark"),
    ("sql", "SQL"),
    ("statistics", "Statistics"),
    ("tableau", "Tableau"),
    ("tensorflow", "TensorFlow"),
    ("tensorflow 2", "TensorFlow"),
    ("terraform", "Terraform"),
    ("tf", "TensorFlow"),
    ("torch", "PyTorch"),
    ("typescript", "TypeScript"),
)

DEFAULT_CATEGORY = "other"


def skill_lookup_rows() -> list[tuple[str, str]]:
    """(key, canonical) rows of the default lookup."""
    return list(SKILL_LOOKUP)


def lookup_frame(spark: SparkSession, rows: list[tuple[str, str]] | None = None,
                 categories: dict[str, str] | None = None) -> DataFrame:
    """The lookup as a DataFrame: key, canonical, category."""
    rows = rows if rows is not None else skill_lookup_rows()
    cats = categories or {}
    data = [(k, v, cats.get(v, DEFAULT_CATEGORY)) for k, v in rows]
    return spark.createDataFrame(data, "key string, canonical string, category string")


def lookup_key(c: Column | str) -> Column:
    """Lower-case then strip, as the reference keys its dict."""
    return F.regexp_replace(F.lower(_c(c)), r"(?U)^\s+|\s+$", "")


def canonicalize(df: DataFrame, column: str, lookup: DataFrame | None = None,
                 category_col: str | None = None, categories: dict[str, str] | None = None) -> DataFrame:
    """Replace ``column`` by its canonical name; a miss keeps the title-cased raw value.

    The default lookup is a driver-built constant (73 rows) and is broadcast, so
    the big side is never shuffled; a caller's lookup is broadcast only when its
    planned size is under the broadcast threshold.  With ``category_col`` the
    lookup's category (E23, default 'other') is added too.
    """
    spark = df.sparkSession
    known = None if lookup is not None else len(skill_lookup_rows())
    lk = lookup if lookup is not None else lookup_frame(spark, categories=categories)
    lk = lk.select(F.col("key").alias("__lk_key"), F.col("canonical").alias("__lk_canon"),
                   F.col("category").alias("__lk_cat") if "category" in lk.columns
                   else F.lit(DEFAULT_CATEGORY).alias("__lk_cat"))
    joined = df.join(broadcast_if_small(lk, known_rows=known), lookup_key(column) == F.col("__lk_key"), "left")
    out = joined.withColumn(column, F.coalesce(F.col("__lk_canon"), title_case(column)))
    if category_col:
        out = out.withColumn(category_col, F.when(F.col(column).isNull(), F.lit(None))
                             .otherwise(F.coalesce(F.col("__lk_cat"), F.lit(DEFAULT_CATEGORY))))
    return out.drop("__lk_key", "__lk_canon", "__lk_cat")
