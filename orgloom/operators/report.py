"""Rows, counts and pages of the reports on the directory and on leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a lead's rule is called, and whether it confirms it.
RULES = {
    "email_domain_match": ("confirmed", "Email on the organisation's own domain"),
    "email_on_own_page": ("confirmed", "Email published on the organisation's own pages"),
    "phone_on_own_page": ("confirmed", "Phone published on the organisation's own pages"),
    "fsa_own_page": ("confirmed", "Postal code on the organisation's own pages"),
    "province_fsa_own_page": ("confirmed", "Province derived from that postal code"),
    "city_table_agrees": ("confirmed", "City matches our Canadian city records"),
    "email_third_party": ("review", "Email found on a third-party page"),
    "phone_third_party": ("review", "Phone found on a third-party page"),
    "city_snippet_unconfirmed": ("review", "City from a search snippet, unconfirmed"),
    "city_unknown": ("review", "City not in our records"),
    "city_known_needs_pair": ("review", "City needs a matching province"),
    "province_snippet": ("review", "Province from a search snippet, unconfirmed"),
    "unreviewed_field": ("review", "Not yet checked by a rule"),
}
#: What fields are called.
FIELDS = {"email": "Email", "phone": "Phone", "city": "City", "province": "Province", "postal_code": "Postal code", "website": "Website"}


def _of(table: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key]


def rule_level(rule: Column) -> Column:
    return F.coalesce(_of({k: v[0] for k, v in RULES.items()}, rule), F.lit("review"))


def rule_label(rule: Column) -> Column:
    return F.coalesce(_of({k: v[1] for k, v in RULES.items()}, rule), F.lit(RULES["unreviewed_field"][1]))


def field_label(field: Column) -> Column:
    return F.coalesce(_of(FIELDS, field), field)


def lead_rows(leads: DataFrame, tie: str) -> DataFrame:
    """``o, f, v, u, h, l, w, a`` of leads (``org, domain, field, value, source_url, site_host, domain_host, rule, status`` and a tie-breaker).

    The same value of an organisation is shown once: the first, but any confirmed
    one before one to be reviewed. Smallest tie first.
    """
    level = rule_level(F.col("rule"))
    shown = F.struct(
        F.col("org").alias("o"), field_label(F.col("field")).alias("f"), F.col("value").alias("v"), F.coalesce("source_url", F.lit("")).alias("u"),
        F.coalesce(F.when(F.col("site_host") != "", F.col("site_host")), F.when(F.col("domain_host") != "", F.col("domain_host")), F.lit("")).alias("h"), level.alias("l"), rule_label(F.col("rule")).alias("w"), (F.col("status") == "applied").alias("a"),
    )
    rows = leads.groupBy(F.lower("org").alias("__o"), "field", F.lower("value").alias("__v")).agg(F.min_by(shown, F.struct(level != "confirmed", tie)).alias("r"))
    return rows.select("r.*")


def leads_in_order(rows: DataFrame) -> DataFrame:
    """Confirmed leads first, then by organisation and field."""
    return rows.orderBy(F.col("l") != "confirmed", F.lower("o"), "f", "v")


def lead_counts(rows: DataFrame) -> DataFrame:
    """``total, confirmed, review``."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("l") == "confirmed").alias("confirmed"), F.count_if(F.col("l") != "confirmed").alias("review"))


def leads_page(rows: DataFrame, level: str, search: str = "") -> DataFrame:
    """The leads of one tab whose organisation, value or host holds what is searched for."""
    low = search.lower()
    hit = F.lit(True) if not low else F.lower("o").contains(low) | F.lower("v").contains(low) | F.lower("h").contains(low)
    return rows.filter((F.col("l") == level) & hit)


def payload(organizations: DataFrame, score: Column) -> DataFrame:
    """``n, c, p, e, ph, w, s, v``: what the directory page shows of an organisation, '' for what is missing."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return organizations.select(F.col("name").alias("n"), text("city").alias("c"), F.upper(text("province")).alias("p"), text("email").alias("e"), text("phone").alias("ph"), text("website").alias("w"), F.coalesce("social", F.create_map().cast("map<string,string>")).alias("s"), F.coalesce(score, F.lit(0)).alias("v"))


def payload_counts(rows: DataFrame, full: int = 80) -> DataFrame:
    """``total, with_email, with_social, full`` of a payload."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("e") != "").alias("with_email"), F.count_if(F.size(F.map_keys("s")) > 0).alias("with_social"), F.count_if(F.col("v") >= full).alias("full"))


def contact_band(email: Column, phone: Column, n_social: Column) -> Column:
    """80 with address, phone and social channels, 40 with an address, 1 with a phone only, else 0."""
    has = lambda c: F.coalesce(c != "", F.lit(False))
    return F.when(has(email) & has(phone) & (n_social > 0), 80).when(has(email), 40).when(has(phone), 1).otherwise(0)


def window_text(number: int, size: int, total: Column) -> Column:
    """'26-50 of 120' for a page; a page beyond the last is the last."""
    pages = F.greatest(F.ceil(total / size), F.lit(1))
    at = F.least(F.lit(max(number, 1)).cast("long"), pages)
    first = F.when(total == 0, 0).otherwise((at - 1) * size + 1)
    return F.concat(first.cast("string"), F.lit("-"), F.least(at * size, total).cast("string"), F.lit(" of "), total.cast("string"))


def shown_links(social: Column) -> Column:
    """The addresses of a map of social channels that can be opened."""
    return F.map_filter(social, lambda k, v: F.coalesce(v.rlike("^https?:"), F.lit(False)))


def enrichment_gains(found: DataFrame, fields: list[str]) -> DataFrame:
    """Of each field how many rows got it that hadn't: ``field, n``, by columns ``found_x`` and ``have_x``."""
    gained = found.agg(*[F.count_if(F.col(f"found_{f}").isNotNull() & ~F.col(f"have_{f}")).alias(f) for f in fields])
    return gained.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in fields])).alias("x")).select("x.*")
