"""Course recommendations from the shares of courses that users watched."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.operators.caching import reused, spread, written
from tidemark.operators.inner_products import top_inner_products
from tidemark.operators.models import als, als_blocks, blocks_that_fit, number_ids

PERCENT = 100
# Columns of the numbers that stand for ids within ALS.
USER, ITEM = "_user", "_item"
# The largest number of an id.
MOST_ID = (1 << 31) - 1


@dataclass
class Recommender:
    """A model over numbered ids, and the numbers of all ids it knows: ``users`` and ``items``.

    Ids of the columns in ``ready`` are their own numbers, so no join is needed to tell one from the other.
    """

    model: ALSModel
    users: DataFrame
    items: DataFrame
    user: str
    item: str
    ready: tuple[str, ...] = ()

    def numbered(self, users: DataFrame) -> DataFrame:
        """The distinct known ``users`` by number."""
        return users.select(self.user).distinct().join(self.users, self.user).select(USER)

    def named(self, found: DataFrame) -> DataFrame:
        """Recommendations with the ids in place of their numbers."""
        for column, number, table in ((self.user, USER, self.users), (self.item, ITEM, self.items)):
            if column in self.ready:
                found = found.withColumn(column, F.col(number).cast(table.schema[column].dataType))
            else:
                found = found.join(table, number)
        return found.select(self.user, "rank", self.item, "rating")

    def with_numbers(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` with the numbers of their ids; rows are dropped whose ids cannot be known."""
        for column, number, table in ((self.user, USER, self.users), (self.item, ITEM, self.items)):
            if column in self.ready and isinstance(pairs.schema[column].dataType, IntegralType):
                pairs = pairs.where(F.col(column).between(0, MOST_ID)).withColumn(number, F.col(column).cast("int"))
            else:
                pairs = pairs.join(table, column)
        return pairs


def percent_ratings(shares: DataFrame, user: str, item: str, share: str) -> DataFrame:
    """Ratings from 0 to 100."""
    return shares.withColumn(share, F.col(share) * PERCENT).select(user, item, share)


def fit_recommender(
    ratings: DataFrame, user: str, item: str, rating: str, blocks: int | None = None
) -> Recommender:
    """Fit ALS to ids of any type; rows without one of the ids teach nothing.

    Ids that are whole numbers within the range of an int stand for themselves, which one look at their least
    and largest tells. The numbers of others are written to the shared folder, for fitting and scoring read them.
    ``blocks`` follows the cores, or the ids of many ratings, if it is not given, and what an executor can hold;
    other blocks start from other random factors. Ratings are kept on disk, once if ids stand for themselves: they are
    read a few times only, and the fit needs the memory.
    """
    with reused(ratings, StorageLevel.DISK_ONLY) as rated:
        ready = _ready_ids(rated, [user, item])
        names = {user: (USER, "als-users"), item: (ITEM, "als-items")}
        numbers = {c: None if c in ready else written(number_ids(rated, c, name), folder) for c, (name, folder) in names.items()}
        numbered = rated.where(F.col(user).isNotNull() & F.col(item).isNotNull())
        for c, (name, _) in names.items():
            if numbers[c] is None:
                numbered = numbered.withColumn(name, F.col(c).cast("int"))
            else:
                numbered = numbered.join(numbers[c], c)
        named = numbered.select(USER, ITEM, rating)
        with spread(named, keep=len(ready) < len(names), level=StorageLevel.DISK_ONLY) as kept:
            ids = [F.approx_count_distinct(c) for c in (USER, ITEM)] if blocks is None else []
            n, *known = kept.agg(F.count("*"), *ids).first()
            if blocks is None:
                blocks = blocks_that_fit(als_blocks(ratings, rows=n, ids=sum(known)), n)
            model = als(USER, ITEM, rating, blocks=blocks, rows=n).fit(kept)

    def table(column: str, factors: DataFrame) -> DataFrame:
        if numbers[column] is not None:
            return numbers[column]
        number = F.col("id")
        return factors.select(number.cast(ratings.schema[column].dataType).alias(column), number.alias(names[column][0]))

    return Recommender(model, table(user, model.userFactors), table(item, model.itemFactors), user, item, tuple(ready))


def _ready_ids(rated: DataFrame, columns: list[str]) -> list[str]:
    """Those of ``columns`` that hold whole numbers from 0 to the largest int only."""
    whole = [c for c in columns if isinstance(rated.schema[c].dataType, IntegralType)]
    if not whole:
        return []
    ends = rated.agg(*[f(c).alias(f"{name}_{c}") for c in whole for name, f in (("low", F.min), ("high", F.max))]).first()
    return [c for c in whole if ends[f"low_{c}"] is None or (ends[f"low_{c}"] >= 0 and ends[f"high_{c}"] <= MOST_ID)]


def score(recommender: Recommender, pairs: DataFrame) -> DataFrame:
    """``pairs`` with a ``prediction``; those of unknown users or items are dropped."""
    numbered = recommender.with_numbers(pairs)
    return recommender.model.transform(numbered).drop(USER, ITEM)


def top_items(recommender: Recommender, users: DataFrame | None, k: int = 5) -> DataFrame:
    """``user, rank, item, rating``: top ``k`` items for ``users``, or for every known user if None.

    Items are tried by falling norm until none to come can be better, so most pairs are never multiplied.
    """
    factors = _factors_of(recommender, None if users is None else recommender.numbered(users))
    return recommender.named(_by_number(top_inner_products(factors, recommender.model.itemFactors, k)))


def _factors_of(recommender: Recommender, asked: DataFrame | None) -> DataFrame:
    factors = recommender.model.userFactors
    return factors if asked is None else factors.join(asked.withColumnRenamed(USER, "id"), "id", "left_semi")


def _by_number(found: DataFrame) -> DataFrame:
    return found.withColumnsRenamed({"user": USER, "item": ITEM})


def new_recommendations(
    recommender: Recommender, users: DataFrame, history: DataFrame, k: int = 5
) -> DataFrame:
    """Top ``k`` items of ``users`` that are not in their history, ranked from 1.

    Everyone gets ``k`` items, if the model knows so many that are new. What a user has seen is left out in
    the same pass, however long the history.
    """
    user, item = recommender.user, recommender.item
    asked = recommender.numbered(users)
    # history goes in as it is: it is shuffled as lists, which are shorter than the rows that a join with ``asked`` would shuffle
    seen = recommender.with_numbers(history.select(user, item)).select(F.col(USER).alias("user"), F.col(ITEM).alias("item"))
    found = top_inner_products(_factors_of(recommender, asked), recommender.model.itemFactors, k, seen)
    return recommender.named(_by_number(found))


def with_history(recommender: Recommender, users: DataFrame, history: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` items that are new to each user beside the user's history, as rows of kind ``new`` and ``watched``."""
    user, item = recommender.user, recommender.item
    found = new_recommendations(recommender, users, history, k)
    watched = history.join(users.select(user).distinct(), user, "left_semi")
    return found.select(user, item, F.lit("new").alias("kind")).unionByName(
        watched.select(user, item, F.lit("watched").alias("kind"))
    )
