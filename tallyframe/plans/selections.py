"""Everyday selections on three small-schema tables.

books(title, author, year, genre), rooms(type, status, floor, price_per_night),
trains(origin, destination, departure as HH:MM text, duration_min).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def books_by_title(books: DataFrame) -> DataFrame:
    return books.select("title", "author").orderBy(F.col("title").asc_nulls_last())


def books_after(books: DataFrame, year: int = 2000) -> DataFrame:
    return books.where(F.col("year") > year)


def books_of_genre(books: DataFrame, genre: str = "Science") -> DataFrame:
    return books.where(F.col("genre") == genre).orderBy(F.col("year").desc_nulls_last())


def newest_books(books: DataFrame, n: int = 3, ties: tuple[str, ...] = ()) -> DataFrame:
    return books.orderBy(F.col("year").desc_nulls_last(), *ties).limit(n)


def vacant_rooms(rooms: DataFrame) -> DataFrame:
    return rooms.where(F.col("status") == "vacant")


def rooms_priced(rooms: DataFrame, low: float = 80, high: float = 150) -> DataFrame:
    return rooms.where(F.col("price_per_night").between(low, high))


def vacant_rooms_of(rooms: DataFrame, first: str = "double", second: str = "suite") -> DataFrame:
    kind = (F.col("type") == first) | (F.col("type") == second)
    return rooms.where(kind & (F.col("status") == "vacant"))


def upper_rooms(rooms: DataFrame, floor: int = 3, price: float = 100) -> DataFrame:
    return rooms.where((F.col("floor") >= floor) & (F.col("price_per_night") >= price))


def rooms_by_floor(rooms: DataFrame) -> DataFrame:
    return rooms.orderBy(F.col("floor").asc_nulls_last(), F.col("price_per_night").desc_nulls_last())


def trains_from(trains: DataFrame, origin: str = "Central") -> DataFrame:
    return trains.where(F.col("origin") == origin)


def trains_between(trains: DataFrame, first: str = "08:00", last: str = "12:00") -> DataFrame:
    return trains.where(F.col("departure").between(first, last))


def long_trains(trains: DataFrame, minutes: int = 90) -> DataFrame:
    return trains.where(F.col("duration_min") > minutes)


def trains_by_departure(trains: DataFrame) -> DataFrame:
    return trains.orderBy(F.col("departure").asc_nulls_last(), F.col("destination").asc_nulls_last())


def trains_with_period(trains: DataFrame) -> DataFrame:
    """Noon and 17:00 count as afternoon; a train without a departure falls into the last class."""
    departure = F.col("departure")
    period = F.when(departure < "12:00", "Morning").when(departure <= "17:00", "Afternoon").otherwise("Evening")
    return trains.withColumn("period", period)
