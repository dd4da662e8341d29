"""Legislative relations: vote events, person votes, bills, memberships, posts, people, organisations, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .reference import resolve_columns

#: Column names by which exports call what we need, in order of preference. Fixed values.
CANDIDATES = {
    "voteevent": {"vote_id": ["id", "vote_event_id"], "session_id": ["legislative_session_id", "session_id"], "bill_id": ["bill_id"], "start_date": ["start_date", "date"], "result": ["result"]},
    "personvote": {"vote_id": ["vote_event_id", "voteevent_id"], "voter_id": ["voter_id", "person_id"], "voter_name": ["voter_name", "name"], "option": ["option", "vote"]},
    "membership": {"person_id": ["person_id"], "post_id": ["post_id"], "role": ["role"], "start_date": ["start_date"], "end_date": ["end_date"]},
    "bill": {"bill_id": ["id", "bill_id"], "identifier": ["identifier"], "title": ["title"], "classification": ["classification"]},
    "votecount": {"vote_id": ["vote_event_id", "voteevent_id"], "option": ["option"], "n": ["value", "count"]},
    "person": {"person_id": ["id", "person_id"], "name": ["name"], "family_name": ["family_name", "last_name"], "given_name": ["given_name", "first_name"]},
    "post": {"post_id": ["id", "post_id"], "label": ["label"], "role": ["role"], "organization_id": ["organization_id"]},
    "organization": {"organization_id": ["id", "organization_id"], "name": ["name"], "classification": ["classification"]},
    "legislativesession": {"session_id": ["id", "session_id"], "identifier": ["identifier"], "name": ["name"], "start_date": ["start_date"], "end_date": ["end_date"]},
}


def read_ocd(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A relation from Parquet, with our column names."""
    return resolve_columns(spark.read.parquet(f"{path}/{name}"), CANDIDATES[name])


def read_ocd_jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """The same over JDBC; filters and columns are pushed to the database."""
    return resolve_columns(spark.read.format("jdbc").options(url=url, dbtable=name, **options).load(), CANDIDATES[name])
