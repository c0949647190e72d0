"""Raw JSON folder to cleaned parquet tables, and the tables to a graph."""

from __future__ import annotations

from pyspark.sql import SparkSession

from plaudit.operators.cleaning import (
    add_tip_counts,
    checkin_summary,
    clean_businesses,
    clean_reviews,
    clean_tips,
    clean_users,
)
from plaudit.operators.graph import Graph
from plaudit.sources.files import scan_json_lines, write_table
from plaudit.sources.schemas import RAW


def run_etl(spark: SparkSession, raw: str, target: str) -> dict[str, str]:
    """Clean `<raw>/<entity>.json` into `<target>/<table>`; returns the table paths."""
    scans = {name: scan_json_lines(spark, f"{raw}/{name}.json", schema) for name, schema in RAW.items()}
    tips = clean_tips(scans["tip"])
    businesses = clean_businesses(scans["business"], checkin_summary(scans["checkin"]))
    tables = {
        "businesses": add_tip_counts(businesses, tips),
        "users": clean_users(scans["user"]),
        "reviews": clean_reviews(scans["review"]),
        "tips": tips,
    }
    paths = {name: f"{target}/{name}" for name in tables}
    for name, table in tables.items():
        write_table(table, paths[name])
    return paths


def run_graph_build(spark: SparkSession, tables: str, target: str) -> Graph:
    """Build the graph from cleaned tables and write it below `target`."""
    named = {n: spark.read.parquet(f"{tables}/{n}") for n in ("businesses", "users", "reviews", "tips")}
    Graph.build(**named).write(target)
    return Graph.read(spark, target)
