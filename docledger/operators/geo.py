"""Points and addresses: envelopes, shared points, road identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import codes
from ..functions.text import bound

# Two coarse boxes of the country (south, north, west, east).
COUNTRY = ((34.0, 38.65, 125.0, 129.65), (33.1, 33.65, 126.1, 127.0))
# Names of provinces.
PROVINCES = {
    "서울": ("서울특별시", "서울시", "서울"), "경기": ("경기도", "경기"), "인천": ("인천광역시", "인천시", "인천"), "강원": ("강원특별자치도", "강원도", "강원"),
    "부산": ("부산광역시", "부산시", "부산"), "대구": ("대구광역시", "대구시", "대구"), "울산": ("울산광역시", "울산시", "울산"), "경북": ("경상북도", "경북"), "경남": ("경상남도", "경남"),
    "대전": ("대전광역시", "대전시", "대전"), "충북": ("충청북도", "충북"), "충남": ("충청남도", "충남"), "전북": ("전북특별자치도", "전라북도", "전북"), "전남": ("전라남도", "전남"),
    "광주": ("광주광역시", "광주시", "광주"), "제주": ("제주특별자치도", "제주도", "제주"), "세종": ("세종특별자치시", "세종시", "세종"),
}

# Coarse boxes of provinces (south, north, west, east).
REGION_BOUNDS = {
    "서울": (37.40, 37.72, 126.75, 127.20), "경기": (36.85, 38.35, 126.35, 127.95), "인천": (37.20, 37.95, 124.55, 126.90), "강원": (37.00, 38.65, 127.05, 129.45),
    "부산": (34.85, 35.45, 128.70, 129.40), "대구": (35.55, 36.40, 128.25, 129.00), "울산": (35.20, 35.85, 128.90, 129.65), "경북": (35.55, 37.60, 127.70, 130.95),
    "경남": (34.55, 35.95, 127.55, 129.30), "대전": (36.15, 36.65, 127.15, 127.65), "충북": (36.00, 37.25, 127.25, 128.70), "충남": (35.90, 37.15, 125.80, 127.75),
    "전북": (35.25, 36.30, 125.80, 127.95), "전남": (33.90, 35.55, 125.00, 127.95), "광주": (35.00, 35.30, 126.60, 127.05), "제주": (33.10, 33.65, 126.10, 127.00),
    "세종": (36.40, 36.80, 127.10, 127.45),
}
# Patterns of road addresses, of road names set apart, postal prefixes, asides, towns and districts; the precision that counts; a merged province.
ROAD = r"([가-힣0-9]+(?:대로|로|길))\s*(\d+(?:-\d+)?)"
THROUGH_ROAD = r"(?s)^(.*?(?:[가-힣0-9]+(?:대로|로|길))\s*\d+(?:-\d+)?)"
SPLIT_ROAD = r"(로|대로)\s+(\d+(?:번)?길)"
TOWN, DISTRICT = r"(?:^|\s)([가-힣]+(?:시|군))(?=\s)", r"(?:^|\s)([가-힣]+구)(?=\s)"
EXACT = "institution_marker_or_full_road_address"
MERGED, MERGED_CITY = "전남광주통합특별시", r"^\s*전남광주통합특별시\s+(?:북구|동구|남구|서구|광산구)"
POSTAL = r"^\s*(?:우\s*)?\d{5}\s+|^\s*우\s*\d{5}\s*"
ASIDES = (r"\([^)]*\)", r"\[우편번호[^\]]*\]")


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])


def coordinate_issue(lat: Column, lon: Column, boxes: tuple = COUNTRY) -> Column:
    """INVALID_COORDINATE_RANGE, OUTSIDE_KOREA_OR_OFFSHORE or null."""
    valid = finite(lat) & finite(lon) & lat.between(-90, 90) & lon.between(-180, 180)
    inside = F.lit(False)
    for b in boxes:
        inside = inside | in_box(lat, lon, b)
    return F.when(~F.coalesce(valid, F.lit(False)), "INVALID_COORDINATE_RANGE").when(~inside, "OUTSIDE_KOREA_OR_OFFSHORE")


def clean_pair(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> tuple[Column, Column]:
    """Both coordinates, or null for both if either is missing, not finite or outside the box."""
    good = F.coalesce(finite(lat) & finite(lon) & in_box(lat, lon, box), F.lit(False))
    return F.when(good, lat), F.when(good, lon)


def shared_points(df: DataFrame, lat: str, lon: str, row_id: str, address: str) -> DataFrame:
    """Points of more than one row, and whether these have one address."""
    per = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(lat, lon)
    return per.agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("first_id"), (F.min(address) == F.max(address)).alias("same_address")).filter("n > 1")


def withhold_shared(df: DataFrame, lat: str, lon: str, row_id: str, address: str) -> DataFrame:
    """Rows at one point with different addresses lose their coordinates and go to review; points are never moved."""
    bad = shared_points(df, lat, lon, row_id, address).filter(~F.col("same_address")).select(lat, lon, F.lit(True).alias("__bad"))
    joined = df.join(bad, [lat, lon], "left")
    hit = F.coalesce("__bad", F.lit(False))
    return joined.withColumns({"status": F.when(hit, "REVIEW").otherwise("PASS"), lat: F.when(~hit, F.col(lat)), lon: F.when(~hit, F.col(lon))}).drop("__bad")


def physical_address(c: Column) -> Column:
    """An address through its road and number: no parentheses, postal codes or mail boxes."""
    x = F.regexp_replace(F.regexp_replace(c, ASIDES[0], " "), ASIDES[1], " ")
    x = F.regexp_replace(F.regexp_replace(x, SPLIT_ROAD, "$1$2"), POSTAL, "")
    through = lambda x: bound(F.regexp_extract(x, THROUGH_ROAD, 1), lambda road: F.when(road != "", road).otherwise(x))
    return F.trim(F.regexp_replace(bound(x, through), r"\s+", " "))


def province(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for name, words in PROVINCES.items() for w in words for x in (w, name)])
    merged = F.when(c.rlike(MERGED_CITY), "광주").otherwise("전남")
    return bound(F.regexp_extract(F.trim(c), r"^(\S+)", 1), lambda first: F.when(first == MERGED, merged).otherwise(names[first]))


def road(c: Column) -> Column:
    """Road and number of a physical address without spaces, or null."""

    def named(x: Column) -> Column:
        name, number = F.regexp_extract(x, ROAD, 1), F.regexp_extract(x, ROAD, 2)
        return F.when(name != "", F.concat(name, F.lit(" "), number))

    return bound(physical_address(c), named)


def road_matches(expected: Column, returned: Column) -> Column:
    """Whether an address names the expected road and number; white space inside the name doesn't count."""
    return bound(physical_address(expected), lambda x: _names_road(x, physical_address(returned)))


def _names_road(own: Column, other: Column) -> Column:
    """road_matches() of physical addresses. The pattern is made from the expected road, a row at a time, in the JVM."""
    name, number = F.regexp_extract(own, ROAD, 1), F.regexp_extract(own, ROAD, 2)
    letters = F.array_join(F.filter(F.split(name, ""), lambda c: c != ""), r"\s*")
    pattern = F.concat(F.lit("(?<![가-힣0-9])"), letters, F.lit(r"\s*"), number, F.lit(r"(?![\d-])"))
    return (name != "") & F.regexp_like(other, pattern)


def _region_issue(lat: Column, lon: Column, region: Column) -> Column:
    out = F.lit(False)
    for name, box in REGION_BOUNDS.items():
        out = F.when(region == name, ~in_box(lat, lon, box)).otherwise(out)
    return out


def location_issues(address: Column, lat: Column, lon: Column, returned: Column, precision: Column, official: Column, identity: Column) -> Column:
    """Sorted issue codes of a candidate point for an address: none of nine for a point that passes.

    lat and lon: numbers or texts. Province, road and number, towns and districts of both addresses must agree. Both addresses
    and the province are made once a row, however many tests use them.
    """
    y, x = lat.try_cast("double"), lon.try_cast("double")
    issue = coordinate_issue(y, x)
    states = [w for names in PROVINCES.values() for w in names] + [MERGED]
    exact, identified = F.coalesce(precision == EXACT, F.lit(False)), F.coalesce(identity, F.lit(False))

    def judged(own: Column, other: Column, region: Column) -> Column:
        towns = F.array_except(F.regexp_extract_all(own, F.lit(TOWN), F.lit(1)), F.array(*map(F.lit, states)))
        districts, found = (F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(DISTRICT), F.lit(1)))) for c in (own, other))
        return codes(
            {
                "INVALID_COORDINATE_RANGE": issue == "INVALID_COORDINATE_RANGE",
                "OUTSIDE_KOREA_OR_OFFSHORE": issue == "OUTSIDE_KOREA_OR_OFFSHORE",
                "ADMINISTRATIVE_AREA_MISMATCH": ~region.eqNullSafe(province(other)) | region.isNull(),
                "ROAD_ADDRESS_MISMATCH": ~F.coalesce(_names_road(own, other), F.lit(False)),
                "MUNICIPALITY_MISMATCH": F.size(F.array_except(towns, F.regexp_extract_all(other, F.lit(TOWN), F.lit(1)))) > 0,
                "DISTRICT_MISMATCH": (F.size(districts) > 0) & (districts != found),
                "COORDINATE_REGION_MISMATCH": F.coalesce(_region_issue(y, x, region), F.lit(False)),
                "INSUFFICIENT_PRECISION": ~exact,
                "OFFICIAL_INSTITUTION_IDENTITY_MISMATCH": F.coalesce(official, F.lit(False)) & ~identified,
            }
        )

    other = physical_address(F.coalesce(returned, F.lit("")))
    return bound(physical_address(address), lambda a: bound(other, lambda b: bound(province(a), lambda r: judged(a, b, r))))


def attach_candidates(rows: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """rows with their candidate's columns, n_candidates and status: none is UNRESOLVED, many are for REVIEW, one is judged.

    candidates: key, latitude, longitude, returned_address, precision, official, identity; rows: key, address. Only a point that
    passes is kept: VERIFIED if official, else GEOCODED.
    """
    names = [c for c in candidates.columns if c != key]
    per = candidates.groupBy(key).agg(F.count(F.lit(1)).alias("n_candidates"), F.any_value(F.struct(*names)).alias("__c"))
    joined = rows.hint("merge").join(per, key, "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0).cast("long")))
    one = F.col("n_candidates") == 1
    c = {n: F.when(one, F.col(f"__c.{n}")) for n in names}
    issues = location_issues(F.col("address"), c["latitude"], c["longitude"], c["returned_address"], c["precision"], c["official"], c["identity"])
    issues = F.when(one, issues).when(F.col("n_candidates") > 1, F.array(F.lit("MULTIPLE_CANDIDATES"))).otherwise(F.array().cast("array<string>"))
    out = joined.withColumns({**{n: c[n] for n in ("returned_address", "official")}, "issues": issues, "__lat": c["latitude"], "__lon": c["longitude"]})
    good = one & (F.size("issues") == 0)
    status = F.when(good, F.when(F.col("official"), "VERIFIED").otherwise("GEOCODED")).when(F.col("n_candidates") > 0, "REVIEW").otherwise("UNRESOLVED")
    return out.withColumns({"status": status, "latitude": F.when(good, F.col("__lat").try_cast("double")), "longitude": F.when(good, F.col("__lon").try_cast("double"))}).drop("__c", "__lat", "__lon")


def geocoder_candidates(payloads: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    """Candidates of a geocoder's JSON responses: x is the longitude, y the latitude; only road addresses are exact."""
    kind = "struct<documents:array<struct<x:string,y:string,address_name:string,address_type:string,road_address:struct<address_name:string>>>>"
    rows = payloads.select(key, F.explode(F.from_json(payload, kind)["documents"]).alias("d"))
    exact = (F.col("d.address_type") == "ROAD_ADDR") & F.col("d.road_address").isNotNull()
    return rows.select(
        key,
        F.col("d.y").alias("latitude"),
        F.col("d.x").alias("longitude"),
        F.coalesce(F.nullif(F.col("d.road_address.address_name"), F.lit("")), F.col("d.address_name")).alias("returned_address"),
        F.when(F.coalesce(exact, F.lit(False)), EXACT).otherwise("coarse").alias("precision"),
        F.lit(False).alias("official"),
        F.lit(None).cast("boolean").alias("identity"),
    )
