"""Read-side forms: institutions, sources, manifests and months as a page shows them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of institution types, by code and by a word of the name; words that stand in for what is missing.
TYPES = {
    "detention_center": "구치소", "prison": "교도소", "branch": "지소", "branch_prison": "지소", "private_prison": "민영교도소", "juvenile_reformatory": "소년원", "vocational_training_prison": "직업훈련교도소",
}
TYPE_WORDS, OTHER_TYPE = ("구치소", "교도소", "지소"), "교정기관"
NO_NAME, NO_ADDRESS, NO_FILE = "이름 미상", "주소 정보 없음", "수용자 식단표 원본"
# Short names of regions; titles and badges of data scopes; paths that are never shown.
REGIONS = {
    "서울특별시": "서울", "부산광역시": "부산", "대구광역시": "대구", "인천광역시": "인천", "광주광역시": "광주", "대전광역시": "대전", "울산광역시": "울산", "세종특별자치시": "세종", "경기도": "경기",
    "강원특별자치도": "강원", "강원도": "강원", "충청북도": "충북", "충청남도": "충남", "전라북도": "전북", "전북특별자치도": "전북", "전라남도": "전남", "경상북도": "경북", "경상남도": "경남", "제주특별자치도": "제주",
}
SCOPES = {"excel_ready_only": ("검증 완료 XLS/XLSX 식단 자료", "Excel 검증 완료")}
OTHER_SCOPE = ("공식 수용자 식단 데이터", "검증 완료")
LOCAL = r"^(?:file://|C:\\|/data/)|\\data\\|data/raw|data/production"
MEALS = ("breakfast", "lunch", "dinner")


def _map(names: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def filled(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def type_label(kind: Column) -> Column:
    """Label of an institution type: by its code, else by the first known word in it."""
    out = F.lit(OTHER_TYPE)
    for w in reversed(TYPE_WORDS):
        out = F.when(kind.contains(w), F.lit(w)).otherwise(out)
    return F.coalesce(_map(TYPES)[F.lower(kind)], out)


def region_name(address: Column) -> Column:
    """Short name of the region that an address begins with; the word itself, if it is none of them."""
    first = F.regexp_extract(F.coalesce(address, F.lit("")), r"^\s*(\S*)", 1)
    return F.coalesce(_map(REGIONS)[first], first)


def shown_url(c: Column) -> Column:
    """http(s) URLs only, and none that names a local path."""
    t = F.trim(c)
    return F.when(t.rlike(r"^https?://") & ~t.rlike(LOCAL), t)


def institution(name: Column, full_name: Column, short: Column, kind: Column, address: Column, url: Column) -> Column:
    """struct(name, short_name, type_label, address, region, url)."""
    shown = F.coalesce(filled(full_name, name, short), F.lit(NO_NAME))
    return F.struct(
        shown.alias("name"),
        F.coalesce(filled(short), shown).alias("short_name"),
        type_label(F.coalesce(kind, F.lit(""))).alias("type_label"),
        F.coalesce(filled(address), F.lit(NO_ADDRESS)).alias("address"),
        region_name(address).alias("region"),
        shown_url(url).alias("url"),
    )


def source(filename: Column, title: Column, post_url: Column, old_url: Column, download_url: Column, published: Column, old_published: Column, document: Column, old_document: Column) -> Column:
    """struct(document_id, filename, post_url, download_url, url, published_date): newer names first, then their old aliases."""
    name = F.coalesce(filled(filename, title), F.lit(NO_FILE))
    post, down = shown_url(filled(post_url, old_url)), shown_url(download_url)
    return F.struct(
        filled(document, old_document).alias("document_id"),
        F.element_at(F.split(name, r"[/\\]"), -1).alias("filename"),
        post.alias("post_url"),
        down.alias("download_url"),
        F.coalesce(post, down).alias("url"),
        filled(published, old_published).alias("published_date"),
    )


def scope_label(scope: Column) -> Column:
    """struct(title, badge) of a data scope."""
    pair = lambda x: F.struct(F.lit(x[0]).alias("title"), F.lit(x[1]).alias("badge"))
    out = pair(OTHER_SCOPE)
    for name, x in SCOPES.items():
        out = F.when(scope == name, pair(x)).otherwise(out)
    return out


def months(values: Column) -> Column:
    """Month numbers of texts: those that are numbers from 1 to 12, ascending."""
    return F.sort_array(F.filter(F.transform(values, lambda m: m.try_cast("double")), lambda m: m.between(1, 12)).cast("array<int>"))


def items_of(slot: Column) -> Column:
    """Names of a slot's items, whatever its shape: an object with menu_items, a bare list of texts or of objects, or null."""
    named = "array<struct<name:string>>"
    bare = F.when(F.schema_of_variant(slot) == "ARRAY<STRING>", F.try_variant_get(slot, "$", "array<string>"))
    objects = [F.transform(F.try_variant_get(slot, p, named), lambda x: x["name"]) for p in ("$.menu_items", "$")]
    found = F.coalesce(bare, *objects, F.array().cast("array<string>"))
    return F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")


def month_slots(month: Column) -> Column:
    """array<struct(day, meal, slot)> of a month: its days, else its flat records, of which the later one of a slot counts."""
    days = F.try_variant_get(month, "$.days", "map<string,variant>")
    of_day = lambda d, v: F.transform(F.array(*map(F.lit, MEALS)), lambda m: F.struct(d.alias("day"), m.alias("meal"), _meal(v, m).alias("slot")))
    nested = F.flatten(F.transform(F.map_entries(days), lambda e: of_day(e["key"], e["value"])))
    flat = F.try_variant_get(month, "$.records", "array<struct<meal_date:string,meal_type:string,menu_items:variant>>")
    good = F.filter(flat, lambda r: r["meal_date"].isNotNull() & r["meal_type"].isin(*MEALS))
    last = F.filter(good, lambda r, k: ~F.exists(F.slice(good, k + 2, F.greatest(F.size(good), F.lit(1))), lambda o: (o["meal_date"] == r["meal_date"]) & (o["meal_type"] == r["meal_type"])))
    listed = F.transform(last, lambda r: F.struct(r["meal_date"].alias("day"), r["meal_type"].alias("meal"), r["menu_items"].alias("slot")))
    return F.coalesce(nested, listed)


def _meal(day: Column, meal: Column) -> Column:
    out = F.try_variant_get(day, f"$.{MEALS[-1]}", "variant")
    for m in MEALS[:-1]:
        out = F.when(meal == m, F.try_variant_get(day, f"$.{m}", "variant")).otherwise(out)
    return out
