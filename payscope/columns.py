"""Column mapping and the raw postings schema.

Operators never hard-code a physical column name for an input.  They take a
:class:`PostingColumns` object that maps the logical role (``job_id``,
``salary_from`` ...) to the physical column, so the same plan runs on the
original CSV header (spaces, ``#``) and on snake_case tables.

Derived columns keep fixed names because they are the public output surface.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql.types import StringType, StructField, StructType


@dataclass(frozen=True)
class PostingColumns:
    job_id: str = "Job ID"
    agency: str = "Agency"
    business_title: str = "Business Title"
    positions: str = "# Of Positions"
    job_category: str = "Job Category"
    salary_from: str = "Salary Range From"
    salary_to: str = "Salary Range To"
    salary_frequency: str = "Salary Frequency"
    min_qual: str = "Minimum Qual Requirements"
    job_description: str = "Job Description"
    preferred_skills: str = "Preferred Skills"
    posting_date: str = "Posting Date"
    posting_updated: str = "Posting Updated"
    process_date: str = "Process Date"

    def names(self) -> list[str]:
        return [getattr(self, f.name) for f in fields(self)]


# Header of the postings CSV.
RAW = PostingColumns()

# Same roles, snake_case physical names (what the adapters produce).
SNAKE = PostingColumns(
    job_id="job_id",
    agency="agency",
    business_title="business_title",
    positions="number_of_positions",
    job_category="job_category",
    salary_from="salary_range_from",
    salary_to="salary_range_to",
    salary_frequency="salary_frequency",
    min_qual="minimum_qual_requirements",
    job_description="job_description",
    preferred_skills="preferred_skills",
    posting_date="posting_date",
    posting_updated="posting_updated",
    process_date="process_date",
)


def raw_schema(cols: PostingColumns = RAW, extra: tuple[str, ...] = ()) -> StructType:
    """All-string schema for the raw table: no inference pass, stable types."""
    return StructType(
        [StructField(n, StringType(), True) for n in [*cols.names(), *extra]]
    )


# Derived column names (output surface).
SALARY_MID = "Annual_Salary_Mid"
SALARY_FROM_NUM = "Salary_From_Value"
SALARY_TO_NUM = "Salary_To_Value"
RANGE_MID = "Salary_Range_Mid"
POSTING_DATE = "Posting_Date"
PRIMARY_CATEGORY = "Primary_Job_Category"
QUALIFICATION = "Qualification_Category"
SALARY_FLAG = "Salary_Qual_Flag"
QUAL_MEDIAN = "qual_median_salary"
COMBINED_TEXT = "combined_text"
EXTRACTED_SKILLS = "extracted_skills"
SKILLS_LIST = "skills_list"
SKILLS_COUNT = "skills_count"
SKILL = "skill"
