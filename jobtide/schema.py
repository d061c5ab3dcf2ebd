"""Schemas of the raw and the normalised posting."""

from pyspark.sql import types as T

KEY = "vacancy_id"

# A posting as the source publishes it. Keys that are not declared are dropped
# and declared keys that are absent read as null.
RAW = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("area", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField(
            "salary",
            T.StructType(
                [
                    T.StructField("from", T.IntegerType()),
                    T.StructField("to", T.IntegerType()),
                    T.StructField("currency", T.StringType()),
                ]
            ),
        ),
        T.StructField("description", T.StringType()),
        T.StructField(
            "key_skills",
            T.ArrayType(T.StructType([T.StructField("name", T.StringType())])),
        ),
        T.StructField("published_at", T.StringType()),
    ]
)

# A posting as it is stored. The limits below say what a valid row is.
TARGET = T.StructType(
    [
        T.StructField(KEY, T.StringType(), nullable=False),
        T.StructField("title", T.StringType(), nullable=False),
        T.StructField("city", T.StringType()),
        T.StructField("salary_rub", T.IntegerType()),
        T.StructField("description", T.StringType()),
        T.StructField("skills", T.ArrayType(T.StringType())),
        T.StructField("published_date", T.DateType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)

# Longest id and city.
MAX_ID_CHARS = 50
MAX_CITY_CHARS = 100

# Roubles per unit of currency. A currency not listed counts 1.0.
RATES = {
    "RUR": 1.0,
    "RUB": 1.0,
    "USD": 95.0,
    "EUR": 102.0,
    "KZT": 0.2,
}

# Keys every raw record has to carry.
REQUIRED_KEYS = ("id", "name", "area")

# The skills whose salaries are reported by default.
REPORTED_SKILLS = ("Docker", "Kubernetes", "AWS", "Python", "Ansible")


def target_schema() -> T.StructType:
    """The stored posting, with the columns that may not be null marked so."""
    return TARGET
