"""Expressions over file paths: dataset, archive date, routing destination."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimflow.schemas import DATASETS


def decoded_key(key: Column) -> Column:
    """Undo URL encoding of an event key (``+`` is a space); undecodable text is kept."""
    return F.coalesce(F.try_url_decode(key), key)


def decoded_uri(uri: Column) -> Column:
    """Undo percent encoding of a file URI, where ``+`` stands for itself."""
    return decoded_key(F.replace(uri, F.lit("+"), F.lit("%2B")))


def path_below(uri: Column, root: str) -> Column:
    """Part of a file URI below the folder ``root``, still encoded."""
    plain = root.split("://", 1)[-1].removeprefix("file:").strip("/")
    folder = quote(plain, safe="/!$&'()*+,;=:@~")
    return F.substring_index(uri, f"/{folder}/", -1)


def is_landed(key: Column) -> Column:
    return key.startswith("raw/")


def dataset_of(key: Column) -> Column:
    """Second path segment when it names a known dataset, else NULL."""
    folder = F.get(F.split(key, "/"), F.lit(1))
    return F.when(folder.isin(*DATASETS), folder)


def archive_date_of(path: Column) -> Column:
    """Date folder of an archived or rejected file, NULL when there is none."""
    day = F.regexp_extract(path, r"[/=](\d{4}-\d{2}-\d{2})/", 1)
    return F.when(day != "", day).try_cast("date")


def file_name(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def destination(zone: Column, folder: Column, day: Column, key: Column) -> Column:
    """``<zone>/<folder>/<yyyy-MM-dd>/<file name>``."""
    return F.concat_ws("/", zone, folder, F.date_format(day, "yyyy-MM-dd"), file_name(key))
