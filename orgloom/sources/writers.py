"""Writers of results and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def keep_answers(results: DataFrame, path: str, kept: DataFrame | None = None) -> None:
    """A new state of the cache of answers (``query_hash, results``): answers given again replace those in ``kept``. Write it to a new folder."""
    whole = results if kept is None else results.unionByName(kept.join(results.select("query_hash"), "query_hash", "left_anti"))
    whole.write.mode("errorifexists").json(path)


def one_json(df: DataFrame, path: str) -> None:
    """A small result as a single JSON-lines file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def render(template: str, rows: DataFrame, values: dict[str, str], most: int = 10_000) -> str:
    """A report's text: ``__DATA__`` is replaced by the rows as a JSON list, other marks by their values.

    The rows go to the driver, so there may be at most ``most``; more is an error, not a cut.
    """
    data = rows.select(F.to_json(F.struct(*rows.columns)).alias("j")).limit(most + 1).collect()
    if len(data) > most:
        raise ValueError(f"a report holds at most {most} rows")
    for mark, value in values.items():
        template = template.replace(mark, value)
    return template.replace("__DATA__", "[" + ",".join(r.j for r in data).replace("</", "<\\/") + "]")
