"""The ready-made reports on small tables with results worked out by hand."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from tallyfield.operators import metrics, models
from tallyfield.sources import local_rows, write_delimited
from tallyfield.sources.schemas import SCHEMAS, SEPARATORS, column_names
from tallyfield.studies import classifiers, films, gems
from tallyfield.studies.university import TABLES, University

GEMS = [
    (0.5, "Ideal", "E", "VS1", 60.0, 55.0, 1000, 1.0, 1.0, 1.0),
    (1.0, "Fair", "E", "VS1", 62.0, 57.0, 3000, 1.0, 1.0, 1.0),
    (1.5, "Ideal", "E", "VS1", 61.0, 56.0, 9000, 1.0, 1.0, 1.0),
    (5.5, "Good", "E", "VS1", 61.0, 56.0, 11000, 1.0, 1.0, 1.0),
]


def test_gems(spark):
    diamonds = local_rows(spark, GEMS, SCHEMAS["diamonds"])
    assert [(r.cut, r.n_diamonds, r.avg_price, r.avg_carat, r.avg_depth, r.avg_table)
            for r in gems.cut_summary(diamonds).collect()] == [
        ("Fair", 1, 3000.0, 1.0, 62.0, 57.0), ("Good", 1, 11000.0, 5.5, 61.0, 56.0),
        ("Ideal", 2, 5000.0, 1.0, 60.5, 55.5)]
    assert [tuple(r) for r in gems.carat_counts(diamonds).collect()] == [
        ("[0,1)", 2), ("[1,2)", 1), ("[5,6]", 1)]
    assert [tuple(r) for r in gems.carat_summary(diamonds).collect()] == [
        ("[0,1)", 2, 2000.0), ("[1,2)", 1, 9000.0), ("[5,6]", 1, 11000.0)]
    assert [r.price_per_carat for r in gems.by_unit_price(diamonds, 2).collect()] == [6000.0, 3000.0]
    assert gems.by_unit_price(diamonds, 1, highest=False).first().price_per_carat == 2000.0


def test_gems_as_lines(spark):
    header = "\t".join(column_names("diamonds"))
    lines = local_rows(
        spark, [[header], *[["\t".join(map(str, row))] for row in GEMS]], "line STRING")
    got = {r.cut: (r.n, r.mean_carat, r.mean_price) for r in gems.cut_means_of_lines(lines, header).collect()}
    assert got == {"Ideal": (2, 1.0, 5000.0), "Fair": (1, 1.0, 3000.0), "Good": (1, 5.5, 11000.0)}


def test_films(spark):
    principals = local_rows(spark, [
        ("t1", "n1", "actor"), ("t1", "n2", "actress"), ("t2", "n1", "actor"), ("t3", "n1", "writer"),
        ("t1", "n3", "director"), ("t2", "n3", "director"), ("t3", "n4", "director"),
        ("t9", "n3", "director"), ("t2", "n5", "actor"),
    ], "imdb_title_id STRING, imdb_name_id STRING, category STRING")
    names = local_rows(spark, [("n1", "Ann"), ("n2", "Bea"), ("n3", "Cy"), ("n4", "Di")],
                       "imdb_name_id STRING, name STRING")
    ratings = local_rows(spark, [("t1", 8.0, 100), ("t2", 7.0, 50), ("t3", 9.0, 1)],
                         "imdb_title_id STRING, rating DOUBLE, total_votes INT")
    movies = local_rows(spark, [("t1", "Drama, Horror"), ("t2", "Comedy"), ("t3", "Horror")],
                        "imdb_title_id STRING, genre STRING")
    assert [tuple(r) for r in films.appearances(principals, names).collect()] == [
        ("Ann", 2), ("Bea", 1), (None, 1)]
    assert [tuple(r) for r in films.director_ratings(principals, ratings, names, 100, 2).collect()] == [
        ("Cy", 3, 150, 7.5)]
    assert films.films_of_genre(movies, "Horror").count() == 2
    assert [tuple(r) for r in films.genre_appearances(principals, movies, names).collect()] == [
        ("Ann", 1), ("Bea", 1)]


@pytest.fixture(scope="module")
def school(spark, tmp_path_factory):
    tables = {
        "accepted": [("19A", 1, "A", "A", "BIO"), ("19A", 2, "B", "B", "BIO"), ("19A", 3, "C", "C", "CHE"),
                     ("20A", 4, "D", "D", "CHE"), ("20A", 5, "E", "E", "MTH")],
        "alumni": [(2,)], "expelled": [(3,)], "unretained": [(5,)],
        "faculty": [(10, "F", "F", "BIO"), (11, "G", "G", "CHE")],
        "course": [("BIO", "B1", None, 3), ("CHE", "C1", None, 1)],
        "grades": [("19A", "B1", 1, 10, "A"), ("19A", "C1", 1, 11, "W"), ("20A", "C1", 1, 11, "A"),
                   ("19A", "B1", 2, 10, "B"), ("19B", "C1", 2, 11, "A"), ("19A", "C1", 3, 11, "F"),
                   ("20A", "C1", 4, 11, "A"), ("20A", "B1", 4, 10, "A")],
    }
    folder = tmp_path_factory.mktemp("school")
    paths = {}
    for name in TABLES:
        df = local_rows(spark, tables[name], SCHEMAS[name])
        paths[name] = write_delimited(df, str(folder / name), SEPARATORS[name])
    return University.read(spark, paths)


def test_university_status(school):
    assert {r.table_name: r.n for r in school.counts().collect()} == {
        "accepted": 5, "alumni": 1, "expelled": 1, "unretained": 1, "faculty": 2, "course": 2, "grades": 8}
    assert {r.cohort: r.n for r in school.status_counts().collect()} == {
        "accepted": 5, "enrolled": 4, "current": 2, "former": 2, "alumni": 1, "unretained": 1, "expelled": 1}
    assert [tuple(r) for r in school.shares_by_major().collect()] == [("BIO", 1, 0.5), ("CHE", 1, 0.5)]
    assert [tuple(r) for r in school.enrollments_by_department("20A").collect()] == [
        ("CHE", 2, 0.6667), ("BIO", 1, 0.3333)]
    assert [tuple(r) for r in school.graduation_rates().collect()] == [("BIO", 1, 1, 1.0), ("CHE", None, 1, None)]
    assert [tuple(r) for r in school.terms_to_graduation().collect()] == [(2, 1)]


def test_university_grades(school):
    # Student 1: 12 + 4 points over 3 + 1 + 1 credits; the W keeps its credit in the denominator.
    assert [(r.sid, r.gpa) for r in school.current_gpa().collect()] == [(1, 3.2), (4, 4.0)]
    assert [r.sid for r in school.perfect_gpa().collect()] == [4]
    assert {r.bucket: r.n for r in school.gpa_histogram().collect() if r.n} == {12: 1, 15: 1}
    shares = {r.fid: r for r in school.grade_distribution().collect()}
    assert (shares[10].N, shares[10].propA, shares[10].propB) == (3, 0.67, 0.33)
    assert (shares[11].N, shares[11].propA, shares[11].propF) == (5, 0.6, 0.2)
    extremes = school.extreme_graders(minimum=4, k=1).collect()
    assert {(r.side, r.fid) for r in extremes} == {("lowest", 11), ("highest", 11)}
    first = {r.sid: r.first_term_gpa for r in school.first_term_gpa().collect()}
    assert first == {1: 3.0, 2: 3.0, 3: 0.0, 4: 4.0}
    assert [tuple(r) for r in school.graduation_by_first_term().collect()] == [("[3,4]", 1, 1, 1.0)]


def test_stroke_study(spark):
    base = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        (F.col("id") % 90).cast("double").alias("age"),
        (F.col("id") % 5 == 0).cast("int").alias("hypertension"),
        (F.col("id") % 7 == 0).cast("int").alias("heart_disease"),
        F.lit("Yes").alias("ever_married"), F.lit("Private").alias("work_type"),
        F.when(F.col("id") % 3 == 0, "Urban").otherwise("Rural").alias("residence_type"),
        (F.col("id") % 100 + 60).cast("double").alias("avg_glucose_level"),
        (F.col("id") % 20 + 18).cast("double").alias("bmi"), F.lit("smokes").alias("smoking_status"),
        (F.col("id") % 90 > 60).cast("int").alias("stroke"))
    study = classifiers.STROKE
    assert study.features[:3] == ["age", "avg_glucose_level", "bmi"] and len(study.features) == 10
    fitted = study.fit_features(base)
    ready = fitted.transform(base)
    quick = dataclasses.replace(study, reg=(0.001,), elastic_net=(0.0,), depth=(2,), min_instances=(4,))
    search = quick.search_tree(ready, study.features, folds=2)
    assert max(search.avgMetrics) > 0.95
    assert max(quick.search_logistic(ready, study.features, folds=2).avgMetrics) > 0.9
    new = local_rows(
        spark, [("Female", 80.0, 1, 0, "Yes", "Private", "Urban", 100.0, 20.0, "smokes"),
                ("Male", 20.0, 0, 0, "Yes", "Private", "Rural", 100.0, 20.0, "smokes")],
        SCHEMAS["stroke"].removesuffix(", stroke INT"))
    scored = models.score(search.bestModel, fitted.transform(new), ["age"]).collect()
    assert {r.age: r.prediction for r in scored} == {80.0: 1.0, 20.0: 0.0}


def test_forest_study(spark):
    study = classifiers.FOREST_COVER
    assert study.features[-2:] == ["Wilderness_Area", "Soil_Type"] and len(study.features) == 12
    columns = [F.lit(1).alias(name) for name in study.numeric[1:]]
    rows = spark.range(400).select(
        (F.col("id") % 40).cast("int").alias(study.numeric[0]), *columns,
        F.concat(F.lit("w"), F.col("id") % 4).alias("Wilderness_Area"),
        (F.col("id") % 38).cast("int").alias("Soil_Type"),
        (F.when(F.col("id") % 40 < 10, 1).when(F.col("id") % 40 < 25, 2).otherwise(7)).alias("Cover_Type"))
    ready = study.fit_features(rows).transform(rows)
    quick = dataclasses.replace(study, depth=(4,), min_instances=(1,))
    search = quick.search_tree(ready, study.features, folds=2)
    scored = models.score(search.bestModel, ready, ["Cover_Type"])
    assert metrics.accuracy(scored, "Cover_Type", "prediction").first().accuracy > 0.95
