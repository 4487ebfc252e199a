"""Zones laid out by day (``year=/month=/day=`` or one ISO date): reading a trailing
window opens, and lists, only the folders of its days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from placeframe.constants import WINDOW_DAYS
from placeframe.schemas import with_string_parts
from placeframe.session import folder_names, path_exists

_FORMS = {"year": "%Y", "month": "%m", "day": "%d"}


def _forms(parts: Sequence[str]) -> list[str]:
    """How each part writes its share of a day."""
    if len(parts) == 1:
        return ["%Y-%m-%d"]
    if tuple(parts) != tuple(_FORMS):
        raise ValueError(f"a zone by day has the parts {', '.join(_FORMS)}, or one ISO date; not {', '.join(parts)}")
    return [_FORMS[p] for p in parts]


def day_folder(day: dt.date, parts: Sequence[str]) -> str:
    return "/".join(f"{p}={day.strftime(f)}" for p, f in zip(parts, _forms(parts)))


def latest_day(spark: SparkSession, root: str, parts: Sequence[str]) -> dt.date | None:
    """The last day that has a folder. Folders are listed level by level, from the greatest on;
    names that are no date (the null folder, foreign ones) are passed over."""

    def last(path: str, k: int, said: str) -> dt.date | None:
        if k == len(parts):
            return dt.datetime.strptime(said, " ".join(forms)).date()
        values = [n.removeprefix(f"{parts[k]}=") for n in folder_names(spark, path) if n.startswith(f"{parts[k]}=")]
        for value in sorted(values, reverse=True):
            try:
                whole = f"{said} {value}".strip()
                dt.datetime.strptime(whole, " ".join(forms[: k + 1]))
            except ValueError:
                continue
            day = last(f"{path}/{parts[k]}={value}", k + 1, whole)
            if day is not None:
                return day
        return None

    forms = _forms(parts)
    return last(root.rstrip("/"), 0, "")


def read_day_window(
    spark: SparkSession,
    root: str,
    schema: StructType,
    parts: Sequence[str] = ("year", "month", "day"),
    days: int = WINDOW_DAYS,
    as_of: str | dt.date | None = None,
    fmt: str = "parquet",
) -> tuple[DataFrame, dt.date | None]:
    """(rows, window end) of the days [end - days, end], both ends inclusive.

    The end is ``as_of`` or the zone's last day, found from folder names. The days of the
    window are known then, so only their folders (``days`` + 1 at most) are opened; the rest of
    the zone is neither listed nor read. The parts come back as strings. A zone or a
    window without a folder gives no rows; the end is None if the zone has no day at all.
    """
    end = dt.date.fromisoformat(str(as_of)) if as_of is not None else latest_day(spark, root, parts)
    whole = with_string_parts(schema, parts)
    window = [end - dt.timedelta(days=i) for i in range(days, -1, -1)] if end is not None else []
    paths = [p for p in (f"{root.rstrip('/')}/{day_folder(d, parts)}" for d in window) if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], whole), end
    return spark.read.format(fmt).schema(whole).option("basePath", root).load(paths), end
