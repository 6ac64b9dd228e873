"""Rules of a run as columns: signals and hard negatives of attempts, how a route is fetched, what a plan allows, what a model's response used; rows that still need a search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from ..functions import text as T
from .records import rank_routes
from .scoring import symptoms

#: Texts of pages that aren't there, of parked domains and of directories.
SOFT_404 = ("404", "page not found", "the requested page does not exist", "страница не найдена", "запрашиваемая страница не найдена", "запрошенная страница не существует")
PARKED = ("domain is for sale", "this domain is for sale", "buy this domain", "domain parking", "sedoparking", "afternic", "parkingcrew")
DIRECTORY = ("каталог компаний", "справочник организаций", "база компаний", "directory of companies", "business directory")

#: Route families by how they are fetched.
NO_BROWSER = ("api", "asset", "static", "image", "images", "img", "css", "js", "javascript", "feed", "robots", "sitemap")
BROWSER_FIRST = ("search", "files", "procurement", "tenders", "sales", "warehouse", "stock")
HIGH_VALUE_SECTIONS = ("homepage", "about", "contacts", "products", "services", "files", "search")
HIGH_VALUE_FAMILIES = ("homepage", "about", "company/about", "contacts", "products", "production/products", "services", "files", "search")
ESCALATED = ("about", "catalog", "company", "contact", "files", "news", "product", "production", "procurement", "sale", "search", "service", "stock", "surplus", "tender", "tmc", "mtr", "warehouse")


def holds(text: Column, marks: Sequence[str]) -> Column:
    found = F.lit(False)
    for m in marks:
        found = found | F.contains(text, F.lit(m))
    return found


def low(x: Column) -> Column:
    return F.lower(T.one_space(x))


def signal_tags(status: Column, reason: Column, http_status: Column, challenge: Column, cooldown: Column) -> Column:
    """The signals of an attempt in order: cooldown, http_429, http_403, bot_gate, challenge. Nulls say nothing."""
    s, r, yes = low(status), low(reason), lambda c: F.coalesce(c, F.lit(False))
    return symptoms({
        "cooldown": yes(cooldown > 0), "http_429": yes(http_status == 429) | s.isin("http_429", "rate_limited") | (r == "http_429"), "http_403": yes(http_status == 403) | (s == "http_403") | (r == "http_403"),
        "bot_gate": (s == "bot_gate") | (r == "bot_gate"), "challenge": yes(challenge) | F.contains(s, F.lit("challenge")) | F.contains(r, F.lit("challenge")),
    })


def hard_negatives(http_status: Column, url: Column, text: Column, bot_gate: Column) -> Column:
    """What speaks against a page whatever else does: http_<status> from 400, soft_404, domain_parking, directory_portal, anti_bot_gate, non_corporate_domain."""
    shown = F.left(F.lower(F.concat_ws("\n", F.coalesce(url, F.lit("")), T.one_space(text))), F.lit(12_000))
    domain = T.registered_domain(T.host(url))
    named = symptoms({"soft_404": holds(shown, SOFT_404), "domain_parking": holds(shown, PARKED), "directory_portal": holds(shown, DIRECTORY), "anti_bot_gate": F.coalesce(bot_gate, F.lit(False)), "non_corporate_domain": F.coalesce((domain != "") & ~T.is_corporate(domain), F.lit(False))})
    return F.array_distinct(F.concat(F.array_compact(F.array(F.when(http_status >= 400, F.concat(F.lit("http_"), http_status.cast("string"))))), named))


def route_transport(mode: Column, family: Column, section: Column) -> Column:
    """How a route is fetched: transport (skip, playwright or requests), browser_allowed, browser_first and the reason of the policy."""
    m, f, s = low(mode), low(family), low(section)
    tokens = F.concat_ws(" ", F.nullif(f, F.lit("")), F.nullif(s, F.lit("")))
    wanted = F.coalesce(F.nullif(m, F.lit("")), F.lit("requests"))
    reason = (
        F.when(holds(tokens, NO_BROWSER), "route_family_no_browser").when(f.isin(*BROWSER_FIRST), "route_family_browser_first").when(s.isin(*HIGH_VALUE_SECTIONS) | f.isin(*HIGH_VALUE_FAMILIES), "route_family_high_value")
        .when(holds(tokens, ESCALATED), "route_family_browser_allowed").otherwise("route_family_requests_only")
    )
    first = reason == "route_family_browser_first"
    allowed = ~reason.isin("route_family_no_browser", "route_family_requests_only")
    asked = wanted == "playwright"
    transport = F.when(wanted == "skip", "skip").when(asked | ((wanted == "hybrid") & first), "playwright").otherwise("requests")
    return F.struct(transport.alias("transport"), (asked | allowed).alias("browser_allowed"), first.alias("browser_first"), F.when(asked, "requested_playwright").otherwise(reason).alias("reason"))


def allows_deep_check(status: Column, site_class: Column, worth: Column) -> Column:
    """Whether a plan goes deeper: the probe succeeded, the class isn't D, E or F, and the site isn't marked as not worth it (null or unknown: it is)."""
    worthwhile = low(worth).isin("true", "limited", "1", "yes", "y", "on")
    return F.coalesce((status == "success") & ~F.coalesce(site_class, F.lit("")).isin("D", "E", "F") & worthwhile, F.lit(False))


def response_facts(raw: Column, prices: tuple[str, str, str]) -> Column:
    """Of a model's stored response (JSON text): what its output holds, and tokens and cost by its usage; a response that isn't an object has nothing, and its cost is unknown.

    input_tokens, cached_tokens, output_tokens, cost (null: unknown), status, incomplete_reason, has_output, content_types (distinct, in order), has_text, has_parsed, has_refusal.
    """
    content = "array<struct<content: array<struct<type: string, parsed: string>>>>"
    parsed = F.from_json(raw, f"status string, incomplete_details struct<reason: string>, output {content}, usage struct<input_tokens: bigint, output_tokens: bigint, input_tokens_details: struct<cached_tokens: bigint>>")
    items = F.coalesce(F.flatten(F.transform(parsed["output"], lambda o: F.coalesce(o["content"], F.array().cast("array<struct<type: string, parsed: string>>")))), F.array().cast("array<struct<type: string, parsed: string>>"))
    usage = parsed["usage"]
    cached = F.coalesce(usage["input_tokens_details"]["cached_tokens"], F.lit(0))
    has = lambda kind: F.exists(items, lambda x: F.coalesce(x["type"] == kind, F.lit(False)))
    types = F.array_distinct(F.filter(F.transform(items, lambda x: T.one_space(x["type"])), lambda t: t != ""))
    return F.struct(
        usage["input_tokens"].alias("input_tokens"), cached.alias("cached_tokens"), usage["output_tokens"].alias("output_tokens"), numbers.usage_cost(usage["input_tokens"], cached, usage["output_tokens"], prices).alias("cost"),
        parsed["status"].alias("status"), parsed["incomplete_details"]["reason"].alias("incomplete_reason"), F.coalesce(F.size(parsed["output"]) > 0, F.lit(False)).alias("has_output"), types.alias("content_types"),
        has("output_text").alias("has_text"), F.exists(items, lambda x: x["parsed"].isNotNull()).alias("has_parsed"), has("refusal").alias("has_refusal"),
    )


def rows_to_search(rows: DataFrame, key: str, done: DataFrame, pending: DataFrame) -> DataFrame:
    """Rows that a resumed run still looks up: neither done nor waiting as a unit of work. Rows without a key are always looked up."""
    gone = done.select(F.col(key).alias("__k")).unionByName(pending.select(F.col(key).alias("__k"))).filter("__k is not null").distinct()
    return rows.join(gone, F.col(key) == F.col("__k"), "left_anti")


def with_depth_caps(routes: DataFrame, path: str, family: str, deepest: Mapping[str, int], default: int) -> DataFrame:
    """routes with depth (parts of the path) and too_deep, by the cap of their family."""
    depth = F.size(F.filter(F.split(F.coalesce(F.col(path), F.lit("")), "/"), lambda p: p != ""))
    cap = F.lit(default)
    for name, most in deepest.items():
        cap = F.when(F.col(family) == name, most).otherwise(cap)
    return routes.withColumns({"depth": depth, "too_deep": depth > cap})


def planned_routes(routes: DataFrame, site: str, family: str, host: str, path: str, score: str, deepest: Mapping[str, int], default: int, **caps) -> DataFrame:
    """The outcomes of rank_routes for routes within the depth of their family, and depth_cap for those beyond it; with depth."""
    measured = with_depth_caps(routes, path, family, deepest, default)
    ranked = rank_routes(measured.filter(~F.col("too_deep")).drop("too_deep"), site, family, host, path, score, **caps)
    deep = measured.filter("too_deep").drop("too_deep").withColumns({"place": F.lit(0), "outcome": F.lit("depth_cap")})
    return ranked.unionByName(deep)


def budget_accounting(outcomes: DataFrame, site: str, family: str, outcome: str, depth: str, per_family: int, reasons: Sequence[str]) -> DataFrame:
    """Per site and family: routes, chosen ones and their cap, the deepest chosen, how many each cap held back (n_<reason>), and coverage: covered, or coverage_floor_unmet."""
    chosen = F.col(outcome) == "selected"
    held = [F.count_if(F.col(outcome) == r).alias(f"n_{r}") for r in reasons]
    sums = outcomes.groupBy(site, family).agg(F.count(F.lit(1)).alias("n_routes"), F.count_if(chosen).alias("n_selected"), F.max(F.when(chosen, F.col(depth))).alias("deepest"), *held)
    return sums.withColumns({"family_cap": F.lit(per_family), "coverage": F.when(F.col("n_selected") > 0, "covered").otherwise("coverage_floor_unmet")})
