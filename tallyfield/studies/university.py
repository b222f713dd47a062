"""A university: accepted students, grades, courses, faculty, and the students who left."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfield.functions import bin_label, map_category, presets, ratio
from tallyfield.operators import aggregates, joins
from tallyfield.sources import read_delimited, row_counts

TABLES = ("accepted", "alumni", "expelled", "unretained", "faculty", "course", "grades")


@dataclass(frozen=True)
class University:
    accepted: DataFrame
    alumni: DataFrame
    expelled: DataFrame
    unretained: DataFrame
    faculty: DataFrame
    course: DataFrame
    grades: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, paths: dict[str, str]) -> "University":
        """Read every table from its path with its registered schema."""
        return cls(**{name: read_delimited(spark, paths[name], name) for name in TABLES})

    def counts(self) -> DataFrame:
        return row_counts({name: getattr(self, name) for name in TABLES})

    def exits(self) -> dict[str, DataFrame]:
        return {"alumni": self.alumni, "unretained": self.unretained, "expelled": self.expelled}

    def flags(self) -> DataFrame:
        return joins.cohort_flags(self.accepted, "sid", self.grades, self.exits())

    def status_counts(self) -> DataFrame:
        return joins.cohort_sizes(self.accepted, "sid", self.grades, self.exits())

    def current(self) -> DataFrame:
        """Enrolled students in none of the exit tables."""
        enrolled = joins.keep_in(self.accepted, self.grades, "sid")
        return joins.drop_in(enrolled, "sid", *self.exits().values())

    def shares_by_major(self) -> DataFrame:
        shares = aggregates.class_share(self.current(), "major")
        return shares.orderBy(F.col("share").desc(), "major")

    def enrollments_by_department(self, term: str) -> DataFrame:
        """Enrolments are counted per course before the department lookup."""
        per_course = aggregates.count_by(
            self.grades.filter(F.col("term_id") == term), "course", name="n_course")
        per_dept = joins.lookup(per_course, self.course.select("course", "dept"), "course")
        counts = per_dept.groupBy("dept").agg(F.sum("n_course").alias("n_students"))
        total = per_course.agg(F.sum("n_course"))
        return aggregates.share_of_total(counts, total, "n_students").orderBy(
            F.col("n_students").desc(), "dept")

    def graduation_rates(self) -> DataFrame:
        former = self.flags().filter("is_former")
        n_former = aggregates.count_by(former, "major", name="n_former")
        n_alumni = aggregates.count_by(former.filter("alumni"), "major", name="n_alumni")
        return joins.outer_rate(
            n_alumni, n_former, "major", "n_alumni", "n_former", name="grad_rate").orderBy("major")

    def terms_to_graduation(self) -> DataFrame:
        graded = joins.match(self.grades, self.alumni, "sid")
        return aggregates.distinct_count_frequency(
            graded, "sid", "term_id", "n_terms", "n_alumni").orderBy("n_terms")

    def scored(self) -> DataFrame:
        """Grades with credits and grade points; a grade without points scores NULL."""
        graded = joins.match(self.grades, self.course.select("course", "credits"), "course")
        return graded.withColumn("points", map_category("grade", presets.GRADE_POINTS))

    def current_gpa(self) -> DataFrame:
        gpa = aggregates.weighted_mean_by(self.scored(), ["sid"], "points", "credits", name="gpa")
        return joins.match(gpa, self.current(), "sid").select(
            "sid", "first_name", "last_name", "major", "gpa").orderBy("gpa", "sid")

    def perfect_gpa(self) -> DataFrame:
        return self.current_gpa().filter("gpa = 4.0")

    def gpa_histogram(self) -> DataFrame:
        return aggregates.histogram(self.current_gpa(), "gpa", 0.0, 0.25, 16).orderBy("bucket")

    def grade_distribution(self) -> DataFrame:
        """Per instructor: the number of grades and the share of each letter."""
        letters = {f"prop{letter}": letter for letter in presets.GRADE_POINTS}
        shares = aggregates.conditional_shares(self.grades, ["fid"], "grade", letters, count_name="N")
        return joins.match(shares, self.faculty, "fid").select(
            "fid", "first_name", "last_name", "dept", "N", *letters)

    def extreme_graders(self, minimum: int = 100, k: int = 10) -> DataFrame:
        """Who gives the fewest and the most A grades."""
        return aggregates.supported_extremes(
            self.grade_distribution(), "N", minimum, "propA", "fid", k)

    def first_term_gpa(self) -> DataFrame:
        """Points and credits are added up per student and term before the two-key join."""
        sums = self.scored().groupBy("sid", "term_id").agg(
            F.sum(F.col("points") * F.col("credits")).alias("points"),
            F.sum("credits").alias("credits"))
        first = joins.first_period_rows(sums, self.accepted, "sid", "term_id", "acc_term_id")
        return first.select("sid", ratio(F.col("points"), F.col("credits"), 2).alias("first_term_gpa"))

    def graduation_by_first_term(self) -> DataFrame:
        binned = self.first_term_gpa().select(
            "sid", bin_label("first_term_gpa", presets.GPA_BINS).alias("gpa_bin"))
        flagged = joins.match(binned, self.flags(), "sid")
        return joins.rate_per_bin(
            flagged, "gpa_bin", "alumni", "is_former", "n_alumni", "n_former", name="grad_rate"
        ).orderBy("gpa_bin")
