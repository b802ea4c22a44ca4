"""Web hosts and e-mail addresses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lotwise import rules
from lotwise.functions.text import fold, let, strip, tokens


def host_of(value: Column) -> Column:
    """Registrable host of a URL or mail field; null for free mail, placeholders and broken text."""
    v = F.regexp_replace(strip(F.lower(value)), r"^[a-z][a-z0-9+.-]*://", "")
    v = F.regexp_replace(v, r"(?s)^.*@", "")
    v = F.regexp_replace(v, r"(?s)[/?#].*$", "")
    v = F.regexp_replace(F.substring_index(v, ":", 1), r"^www\.", "")
    v = F.btrim(v, F.lit(". "))
    unusable = rules.FREEMAIL + rules.PLACEHOLDER_HOSTS
    return let(v, lambda host: F.when(host.rlike(rules.HOST_PATTERN) & ~host.isin(unusable), host))


def clean_domain(value: Column) -> Column:
    d = strip(F.lower(F.coalesce(value, F.lit(""))))
    for prefix in (r"^https://", r"^http://", r"^www\."):
        d = F.regexp_replace(d, prefix, "")
    return strip(F.substring_index(d, "/", 1))


def domain_stem(domain: Column) -> Column:
    """The label left of the top-level domain."""
    parts = F.split(domain, r"\.")
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2)).otherwise(F.element_at(parts, 1))


def tld_of(domain: Column) -> Column:
    return F.lower(F.substring_index(F.coalesce(domain, F.lit("")), ".", -1))


def name_matches_domain(company_key: Column, domain: Column) -> Column:
    """A key token of four or more characters occurs in the domain, or a short one is a
    whole hyphen label of its first part."""
    flat = F.replace(F.replace(fold(domain), F.lit("-")), F.lit("."))
    labels = F.split(F.substring_index(domain, ".", 1), "-")
    bare = F.transform(tokens(company_key), lambda t: F.replace(t, F.lit("-")))
    hit = F.exists(bare, lambda t: ((F.length(t) >= 4) & flat.contains(t))
                   | (F.length(t).between(2, 3) & F.array_contains(labels, t)))
    return F.coalesce(hit, F.lit(False))


def email_domain(email: Column) -> Column:
    return F.lower(F.substring_index(F.coalesce(email, F.lit("")), "@", -1))


def domain_check(email_dom: Column, company_dom: Column) -> Column:
    return F.when(email_dom == company_dom, F.lit("ok")).otherwise(
        F.concat(F.lit("PRUEFEN: "), email_dom, F.lit(" vs "), company_dom))
