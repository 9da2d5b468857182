"""Map images: which file each country and map type has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierkit.operators.resolve import candidate_urls, candidates, first_available
from dossierkit.sources.dims import MAP_EXTENSIONS, MAP_TYPES, map_name
from dossierkit.sources.landed import fetched

# Where the images are and where they go.
MAP_URL = "https://srv1.worldometers.info/img/maps/%s_%s_map.%s"
MAP_PATH = "country_maps/%s/%s_%s_map.%s"


def map_requests(countries: DataFrame) -> DataFrame:
    """``countries(country)`` to every URL that may hold a map, with the path it would be kept at."""
    named = countries.select("country", F.expr(map_name("country")).alias("url_name"))
    tried = candidates(named, ("map_type", MAP_TYPES), ("extension", MAP_EXTENSIONS))
    urls = candidate_urls(tried, MAP_URL, "url_name", "map_type", "extension")
    return candidate_urls(urls, MAP_PATH, "country", "country", "map_type", "extension", name="path").select(
        "country", "map_type", "extension", "extension_no", "url", "path"
    )


def map_files(requests: DataFrame, log: DataFrame) -> DataFrame:
    """First request per country and map type that ``log(url, status)`` has content for; misses stay."""
    seen = log.groupBy("url").agg(F.bool_or(fetched(F.col("status"))).alias("ok"))
    # A log has as many rows as there are requests: it is not to be sent to every task, small as its files may be.
    tried = requests.join(seen.hint("merge"), "url", "left")
    found = first_available(tried, ["country", "map_type"], ["extension_no"], F.col("ok"))
    return found.select("country", "map_type", "extension", "url", "path")
