"""Ordered rules over text, as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound, split_items, squeeze

# Spreadsheet error tokens, exact labels and anchored patterns of tokens that are no menu items.
EXCEL_ERRORS = (
    "#REF!", "#VALUE!", "#DIV/0!", "#N/A", "#NAME?", "#NUM!", "#NULL!", "#SPILL!", "#CALC!", "#GETTING_DATA", "#CONNECT!", "#BLOCKED!", "#FIELD!", "#BUSY!", "#UNKNOWN!",
    "#PYTHON!", "#DATA!",
)
SUBTOTALS = ("소계", "합계", "총계")
COST_LABELS = ("부식물단가", "예정인원", "일일급식예정금액", "1일1인당평균부식지급액", "1인1일평균", "월중급식", "1인1일급식비", "1인1일부식비급여예정액", "(주식,부식,연료비등포함)")
COST_PATTERNS = (
    r"[※*]?1식(?:급양비|매식비)단가[\d,.]*원?",
    r"[※*]?(?:\d+[.)])?(?:1인당1식단가는|1인1일부식단가|1일평균단가:|1일총급식비:)[\d,.]*원?",
    r"[\d,.]+원\((?:주부식연료비포함|주,부식,연료비등포함)\)",
)
INSTRUCTION = (
    r"[※*]?(?:\d+[.)])?(?:가격변동시물량으로조절(?:급식)?|가격변동시물량조절및대체할수있음|부식비범위내물량으로조절(?:할수있음)?|"
    r"예정단가초과시물량으로조절함|물량공급이어려울시동일식군내대체가능|동일식군내상호대체(?:할수있음)?)[.]?"
)
# Secrets and private paths.
SECRETS = {
    "google_api_key": r"AIza[0-9A-Za-z_-]{30,}",
    "github_token": r"(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{30,})",
    "private_key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "bearer_credential": r"Bearer\s+[A-Za-z0-9_.-]{20,}",
    "assigned_credential": r"""(?i)(?:password|api_key|token|secret)\s*[=:]\s*["'][A-Za-z0-9_./+-]{20,}["']""",
    "private_windows_path": r"(?i)(?:C:[\\/]+Users[\\/]+|E:[\\/]+workspace[\\/]+)",
}
# Words of document roles.
INMATE = r"수용자|수용자용|수용\s*식|소년수용|일반수용"
STAFF = r"직원|직원용|교도관|의무교도대원"
SUPPLEMENTARY = r"빵(?:과자)?표|빵\s*공급(?:일정)?표|과자\s*(?:공급)?일정표|간식\s*(?:공급)?일정표|별도\s*공급(?:일정)?|부식물"
OTHER_ROLE = r"개인정보|업무추진비|접견|민원|보도|채용|자비구매의약품|의약품|구매\s*코드표|코드표"
MEAL_TABLE = r"차림표|식단표"
# Titles of meal plans.
MEAL_TITLES = (
    r"수용자\s*(?:(?:,|·|/|및)\s*직원)?\s*식단표",
    r"직원\s*(?:,|·|/|및)\s*수용자\s*식단표",
    r"수용자.{0,8}(?:급식|부식물).{0,8}(?:식단표|차림표|메뉴표)",
    r"(?:급식\s*)?식단표.{0,8}수용자",
)


def whole(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")


def first_match(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """Value of the first rule that holds."""
    out = otherwise
    for test, value in reversed(rules):
        out = F.when(test, value).otherwise(out)
    return out


def token_category(token: Column, squeezed: Column | None = None) -> Column:
    """What a token is, if no item: the first of seven categories that matches it whole; null for items.

    token should be NFKC-normalised where it may hold compatibility characters. squeezed: its comparison form as a
    column, where there is one; else it is made once a token, and bound to a name that all tests use.
    """
    if squeezed is None:
        return bound(squeeze(token), lambda t: token_category(token, t))
    t = squeezed
    label = lambda x: F.lit(x)
    cost = t.isin(*COST_LABELS)
    for p in COST_PATTERNS:
        cost = cost | whole(t, p)
    return first_match(
        [
            (F.ltrim(token).startswith("="), label("formula_literal")),
            (F.upper(t).isin(*EXCEL_ERRORS), label("excel_error")),
            (t.isin(*SUBTOTALS), label("subtotal")),
            (whole(t, r"[\d,]+(?:\.\d+)?원"), label("price")),
            (whole(t, r"0+(?:\.0+)?|-"), label("placeholder")),
            (cost, label("cost_metadata")),
            (whole(t, INSTRUCTION), label("instruction_note")),
        ],
        F.lit(None).cast("string"),
    )


def menu_tokens(text: Column) -> Column:
    """Tokens of a cell's text: one for a single line that is an artifact as a whole, else its items."""
    single = ~text.rlike(r"[\n\r]") & token_category(F.trim(text)).isNotNull()
    return F.when(single, F.array(F.trim(text))).otherwise(split_items(text))


def split_artifacts(items: Column) -> Column:
    """struct(clean, artifacts, unsafe) of an ordered item array.

    Trailing artifacts can be dropped; one before a clean item, a formula or error, or nothing clean left is unsafe.
    """
    tagged = F.transform(items, lambda x: F.struct(x.alias("item"), token_category(x).alias("category")))
    bad = F.filter(tagged, lambda x: x["category"].isNotNull())
    clean = F.transform(F.filter(tagged, lambda x: x["category"].isNull()), lambda x: x["item"])
    first = F.array_position(F.transform(tagged, lambda x: x["category"].isNotNull()), True)
    behind = F.when(first > 0, F.exists(F.slice(tagged, F.greatest(first, F.lit(1)).cast("int"), F.greatest(F.size(tagged), F.lit(1))), lambda x: x["category"].isNull()))
    unsafe = (F.size(clean) == 0) | F.exists(bad, lambda x: x["category"].isin("formula_literal", "excel_error")) | F.coalesce(behind, F.lit(False))
    return F.struct(clean.alias("clean"), bad.alias("artifacts"), unsafe.alias("unsafe"))


def secrets_in(c: Column, patterns: dict[str, str] | None = None) -> Column:
    """Names of the patterns that a text matches, in the order given."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(name)) for name, p in (patterns or SECRETS).items()]))


# Role and confidence of each rule of document roles.
ROLES = {
    "filename_inmate_and_staff": ("mixed", 0.98), "filename_inmate_with_supplementary_term": ("inmate", 0.82), "filename_inmate_keyword": ("inmate", 0.97), "filename_staff_keyword": ("staff", 0.97),
    "filename_supplementary_keyword": ("supplementary", 0.88), "filename_non_meal_admin_keyword": ("other", 0.95), "generic_meal_table_with_staff_sibling": ("unknown", 0.45),
    "ambiguous_title_context_inmate_and_staff": ("unknown", 0.25), "ambiguous_title_context_inmate": ("unknown", 0.25), "ambiguous_title_context_staff": ("unknown", 0.25),
    "generic_meal_table_without_subject": ("unknown", 0.15), "no_matching_rule": ("unknown", 0.0),
}


def document_role(name: Column, title: Column, siblings: Column) -> Column:
    """struct(role, confidence, rule): twelve ordered outcomes. siblings: file names of the same post, itself included."""
    inmate, staff, more = name.rlike(INMATE), name.rlike(STAFF), name.rlike(SUPPLEMENTARY)
    both, table = F.concat_ws(" ", name, title), name.rlike(MEAL_TABLE)
    about_inmates, about_staff = both.rlike(INMATE), both.rlike(STAFF)
    tests = {
        "filename_inmate_and_staff": inmate & staff,
        "filename_inmate_with_supplementary_term": inmate & more,
        "filename_inmate_keyword": inmate,
        "filename_staff_keyword": staff,
        "filename_supplementary_keyword": more,
        "filename_non_meal_admin_keyword": name.rlike(OTHER_ROLE),
        "generic_meal_table_with_staff_sibling": table & F.exists(siblings, lambda s: (s != name) & s.rlike(STAFF)),
        "ambiguous_title_context_inmate_and_staff": about_inmates & about_staff,
        "ambiguous_title_context_inmate": about_inmates,
        "ambiguous_title_context_staff": about_staff,
        "generic_meal_table_without_subject": table,
    }

    def outcome(rule: str) -> Column:
        role, confidence = ROLES[rule]
        return F.struct(F.lit(role).alias("role"), F.lit(confidence).alias("confidence"), F.lit(rule).alias("rule"))

    return first_match([(test, outcome(rule)) for rule, test in tests.items()], outcome("no_matching_rule"))


def publication_gate(**c: Column) -> Column:
    """failed / ready / review. A missing completeness flag passes, a missing quality flag doesn't."""
    zero = lambda k: F.coalesce(c[k], F.lit(0)) == 0
    none = lambda k: F.coalesce(F.size(c[k]) == 0, F.lit(False))
    failed = F.coalesce(c["status"] == "FAIL", F.lit(False)) | F.coalesce(F.size(c["failure_codes"]) > 0, F.lit(False))
    ready = (
        F.coalesce(c["status"] == "PASS", F.lit(False))
        & zero("invalid")
        & F.coalesce(c["coverage_complete"], F.lit(False))
        & none("missing_dates")
        & none("missing_meals")
        & F.coalesce(c["source_provenance_valid"], F.lit(False))
        & F.coalesce(c["institution_id"] != "", F.lit(False))
        & F.coalesce(c["menu_quality_valid"], F.lit(False))
        & F.coalesce(c["source_completeness_valid"], F.lit(True))
        & zero("unresolved_formula_values")
        & zero("excel_error_menu_items")
        & zero("unresolved_non_menu_artifacts")
        & ~F.coalesce(F.exists(c["items"], lambda x: token_category(x).isNotNull()), F.lit(False))
        & ~F.coalesce(F.arrays_overlap(c["issue_codes"], F.array(F.lit("YEAR_INFERRED_FROM_PUBLICATION"), F.lit("PERIOD_CONFLICT"))), F.lit(False))
    )
    return F.when(failed, "failed").when(ready, "ready").otherwise("review")


def mime_mismatch(ext: Column, mime: Column, expected: dict[str, tuple[str, ...]], generic: tuple[str, ...] = ("application/octet-stream", "binary/octet-stream", "")) -> Column:
    """A declared type that is neither generic nor one of the extension's; unknown extensions never mismatch."""
    kind = F.lower(F.trim(F.split(F.coalesce(mime, F.lit("")), ";")[0]))
    out = F.lit(False)
    for x, kinds in expected.items():
        out = F.when(ext == x, ~kind.isin(*generic) & ~kind.isin(*kinds)).otherwise(out)
    return out


def bucket(n: Column, thresholds: tuple[int, ...]) -> Column:
    """'<= t' of the first threshold that n doesn't exceed, else '> last'."""
    return first_match([(n <= t, F.lit(f"<= {t}")) for t in thresholds], F.lit(f"> {thresholds[-1]}"))


def codes(checks: dict[str, Column]) -> Column:
    """Names of the checks that hold, sorted."""
    return F.array_sort(F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in checks.items()])))
