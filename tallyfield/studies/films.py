"""Films: principals (title, person, category), ratings, titles with genres, and person names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfield.functions import ratio
from tallyfield.operators.aggregates import count_by
from tallyfield.operators.joins import keep_in, lookup, top_with_lookup

TITLE, PERSON = "imdb_title_id", "imdb_name_id"


def performers(principals: DataFrame) -> DataFrame:
    return principals.filter(F.col("category").isin("actor", "actress"))


def appearances(principals: DataFrame, names: DataFrame, k: int = 16) -> DataFrame:
    counts = count_by(performers(principals), PERSON, name="appearances")
    order = [F.col("appearances").desc(), F.col(PERSON)]
    return top_with_lookup(counts, names.select(PERSON, "name"), PERSON, order, k).select(
        "name", "appearances")


def director_ratings(
    principals: DataFrame, ratings: DataFrame, names: DataFrame, min_votes: int = 1_000_000,
    min_films: int = 5, k: int = 16,
) -> DataFrame:
    """Directors with enough votes and films, best mean rating first. Unrated films count as
    films but not in the mean."""
    films = principals.filter(F.col("category") == "director")
    measures = lookup(films, ratings.select(TITLE, "rating", "total_votes"), TITLE).groupBy(PERSON).agg(
        F.count(TITLE).alias("num_films"),
        F.sum("total_votes").alias("total_votes"),
        ratio(F.sum("rating"), F.count("rating"), 2).alias("avg_rating"),
    ).filter((F.col("total_votes") >= min_votes) & (F.col("num_films") >= min_films))
    order = [F.col("avg_rating").desc(), F.col(PERSON)]
    return top_with_lookup(measures, names.select(PERSON, "name"), PERSON, order, k).select(
        "name", "num_films", "total_votes", "avg_rating")


def films_of_genre(movies: DataFrame, genre: str) -> DataFrame:
    return movies.filter(F.col("genre").contains(genre))


def genre_appearances(
    principals: DataFrame, movies: DataFrame, names: DataFrame, genre: str = "Horror", k: int = 16
) -> DataFrame:
    titles = films_of_genre(movies, genre).select(TITLE)
    counts = count_by(keep_in(performers(principals), titles, TITLE), PERSON, name="num_films")
    order = [F.col("num_films").desc(), F.col(PERSON)]
    return top_with_lookup(counts, names.select(PERSON, "name"), PERSON, order, k).select(
        "name", "num_films")
