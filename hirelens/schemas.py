"""Schemas of the files and tables the library reads and writes."""

from pyspark.sql import types as T

JOB_FIELDS = [
    "title", "link", "salary", "location", "experience", "description", "requirements",
    "benefits", "work_location_detail", "working_time", "deadline",
]

JOB = T.StructType([T.StructField(name, T.StringType()) for name in JOB_FIELDS])

# A block holds the postings one crawl found for one group. Old files spell the key `skill`.
BLOCK = T.StructType([
    T.StructField("group", T.StringType()),
    T.StructField("skill", T.StringType()),
    T.StructField("jobs", T.ArrayType(JOB)),
])

# Order of the columns in the flat export.
FLAT_FIELDS = [
    "group", "title", "link", "salary_raw", "salary_normalized", "currency_unit", "location",
    "experience", "description", "requirements", "benefits", "work_location_detail",
    "working_time", "deadline", "skills",
]

FLAT = T.StructType([T.StructField(name, T.StringType()) for name in FLAT_FIELDS])

CLEANED = T.StructType([
    T.StructField("group", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("experience", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("requirements", T.StringType()),
    T.StructField("benefits", T.StringType()),
    T.StructField("work_location_detail", T.StringType()),
    T.StructField("working_time", T.StringType()),
    T.StructField("deadline", T.DateType()),
    T.StructField("salary_raw", T.StringType()),
    T.StructField("salary_normalized", T.LongType()),
    T.StructField("currency_unit", T.StringType()),
    T.StructField("skills", T.ArrayType(T.StringType())),
])

# Longest text each column of the relational model takes, in characters.
MAX_LENGTHS = {
    "skill_groups": {"name": 100},
    "skills": {"name": 100},
    "jobs": {
        "title": 255, "location": 255, "experience": 100, "working_time": 255,
        "salary_raw": 100, "currency_unit": 10,
    },
}

# Columns that may not be null.
REQUIRED = {
    "skill_groups": ["id", "name"],
    "skills": ["id", "name"],
    "skill_details": ["skill_id", "group_id"],
    "jobs": ["id", "group_id", "title"],
    "job_details": ["id", "job_id"],
    "job_skills": ["job_id", "skill_id"],
}

# Columns that identify a row.
UNIQUE_KEYS = {
    "skill_groups": [["id"], ["name"]],
    "skills": [["id"], ["name"]],
    "skill_details": [["skill_id", "group_id"]],
    "jobs": [["id"]],
    "job_details": [["id"]],
    "job_skills": [["job_id", "skill_id"]],
}

# (child table, child column, parent table, children follow when the parent goes).
# Every reference points at the parent's `id`.
FOREIGN_KEYS = [
    ("skill_details", "skill_id", "skills", True),
    ("skill_details", "group_id", "skill_groups", True),
    ("jobs", "group_id", "skill_groups", False),
    ("job_details", "job_id", "jobs", True),
    ("job_skills", "job_id", "jobs", True),
    ("job_skills", "skill_id", "skills", True),
]
