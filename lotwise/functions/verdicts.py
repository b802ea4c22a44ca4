"""Rule verdicts over landed evidence: contacts, mail, links, pages, sources, head counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from lotwise import rules
from lotwise.functions.codes import percent
from lotwise.functions.hosts import tld_of
from lotwise.functions.scoring import lookup
from lotwise.functions.text import blank_to_null, company_key, fold, let, register_number, strip, tokens


def _any(hay: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [hay.contains(w) for w in words])


def persona(title: Column, champion: list[str] = rules.CHAMPION_WORDS,
            buyer: list[str] = rules.BUYER_WORDS) -> Column:
    t = F.lower(F.coalesce(title, F.lit("")))
    return (F.when(_any(t, champion), F.lit(rules.PERSONA_CHAMPION))
            .when(_any(t, buyer), F.lit(rules.PERSONA_BUYER))
            .otherwise(F.lit(rules.PERSONA_USER)))


def persona_rank(p: Column) -> Column:
    return lookup(p, {rules.PERSONA_CHAMPION: 0, rules.PERSONA_BUYER: 1}, 2)


def email_status(email: Column, verified: Column, mx: Column, origin: Column | None = None) -> Column:
    """struct(email_status, email_quelle); ``verified`` and ``mx`` come from landed tables.

    ``origin`` says where and when an address was verified; without it the published run counts.
    """
    published = F.lit("apollo_people_bulk_match 23.09.2026")
    e = strip(F.lower(F.coalesce(email, F.lit(""))))
    valid = e.rlike(rules.EMAIL_PATTERN)
    status = (F.when(~valid, F.lit("keine_adresse"))
              .when(verified, F.lit("verifiziert_apollo"))
              .when(mx, F.lit("mx_ok"))
              .when(~mx, F.lit("kein_mx"))
              .otherwise(F.lit("ungeprueft")))
    origin = (F.when(status == "verifiziert_apollo", published if origin is None else F.coalesce(origin, published))
              .when(status == "mx_ok", F.lit("DNS-MX-Abfrage (belegt die Domain, nicht das Postfach)"))
              .when(status == "kein_mx", F.lit("DNS-MX-Abfrage: kein Eintrag"))
              .otherwise(F.lit("")))
    return F.struct(status.alias("email_status"), origin.alias("email_quelle"))


def text_flags(text: Column, flags: list[str] = rules.COPY_FLAGS) -> Column:
    """Sorted list of the flags contained in a text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = F.array(*[F.when(low.contains(f), F.lit(f)) for f in sorted(set(flags))])
    return F.array_compact(hits)


def copy_warning(*texts: Column) -> Column:
    joined = F.concat_ws(" ", *[F.coalesce(t, F.lit("")) for t in texts])
    hits = text_flags(joined)
    return F.when(F.size(hits) > 0, F.concat(F.lit("Textbaustein gibt fehlende Recherche zu: "),
                                             F.array_join(hits, ", "))).otherwise(F.lit(""))


def link_verdict(url: Column, status: Column, size: Column, content_type: Column) -> Column:
    """struct(verdict, reason) for a fetched evidence link: ok, unverifiable or failed."""
    ctype = strip(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1))
    challenge = (status == 202) & (size == 0) & _any(url, rules.CHALLENGE_HOSTS)
    reason = (
        F.when(F.coalesce(url, F.lit("")) == "", F.lit("keine URL"))
        .when(status.isNull() | (status == 0), F.lit("nicht erreichbar"))
        .when(challenge, F.lit("JS-Challenge - maschinell nicht pruefbar"))
        .when(status != 200, F.concat(F.lit("HTTP "), status.cast("string")))
        .when(size.isin(rules.SHELL_BYTES), F.lit("SPA-Huelle - die Seite zeigt im Browser 404"))
        .when(~ctype.isin(rules.OK_TYPES), F.concat(F.lit("unerwarteter Content-Type "), ctype))
        .when(size < rules.MIN_EVIDENCE_BYTES, F.lit("Antwort verdaechtig klein"))
        .otherwise(F.lit(""))
    )
    kind = (F.when(reason == "", F.lit("ok"))
            .when(reason.startswith("JS-Challenge"), F.lit("unverifiable"))
            .otherwise(F.lit("failed")))
    return F.struct(kind.alias("verdict"), reason.alias("reason"))


def probe_finding(status: Column, size: Column, url: Column) -> Column:
    """What a source probe found."""
    return (
        F.when(F.coalesce(url, F.lit("")) == "", F.lit("keine URL hinterlegt"))
        .when(status.isNull() | (status == 0), F.lit("nicht erreichbar"))
        .when(status == 403, F.lit("HTTP 403 - Server blockt HTTP-Clients. Browser noetig "
                                   "(Playwright/Apify), kein Proxy-Problem."))
        .when(status == 404, F.lit("HTTP 404 - Pfad veraltet, Einstieg neu bestimmen"))
        .when(status != 200, F.concat(F.lit("HTTP "), status.cast("string")))
        .when(size < 2000, F.lit("erreichbar, aber verdaechtig wenig Inhalt"))
        .otherwise(F.lit("erreichbar"))
    )


def source_verdict(status: Column, links: Column, checked: Column, quota: Column,
                   min_quota: float = rules.MIN_NAME_QUOTA) -> Column:
    return (
        F.when(status == 403, F.lit("browser_noetig"))
        .when(status.isNull() | status.isin(0, 404), F.lit("einstieg_unklar"))
        .when(links == 0, F.lit("einstieg_unklar"))
        .when(checked == 0, F.lit("text_nicht_lesbar"))
        .when(quota < min_quota, F.lit("zu_stark_anonymisiert"))
        .otherwise(F.lit("brauchbar"))
    )


def verify_candidate(award_name: Column, award_city: Column, cand_name: Column, domain: Column,
                     country: Column, stage: Column) -> Column:
    """Does a looked-up domain belong to the awarded legal entity?

    struct(accepted, domain, candidate_domain, confidence, stage, signals, reject_reason)
    """
    dom = F.lower(F.coalesce(domain, F.lit("")))
    sets = F.struct(tokens(company_key(award_name)).alias("a"),
                    tokens(company_key(F.coalesce(cand_name, F.lit("")))).alias("b"))
    overlap = let(sets, lambda s: F.size(F.array_intersect(s["a"], s["b"]))
                  / F.greatest(F.size(F.array_union(s["a"], s["b"])), F.lit(1)))
    town = fold(F.substring_index(strip(award_city), " ", 1))
    town_hit = F.coalesce((town != "") & fold(F.coalesce(cand_name, F.lit(""))).contains(town), F.lit(False))
    home = F.lower(strip(F.coalesce(country, F.lit("")))).isin("germany", "deutschland")
    facts = F.struct(dom.alias("dom"), overlap.alias("overlap"), town_hit.alias("town"), home.alias("home"))
    return let(facts, lambda f: _candidate_verdict(
        f["dom"], f["overlap"], f["town"], f["home"], award_name, cand_name, stage))


def _candidate_verdict(dom: Column, overlap: Column, town_hit: Column, home: Column, award_name: Column,
                       cand_name: Column, stage: Column) -> Column:
    tld = tld_of(dom)
    foreign = lookup(tld, rules.FOREIGN_TLDS)
    parts = [
        (stage == 1, 0.45, F.lit("Stufe 1 mit Ortsfilter Deutschland")),
        (tld == "de", 0.30, F.lit(".de-Domain")),
        (tld.isin(rules.NEUTRAL_TLDS), 0.10, F.concat(F.lit("neutrale TLD ."), tld)),
        (home, 0.25, F.lit("Apollo-Sitz Deutschland")),
        (overlap >= 0.5, 0.20, F.concat(F.lit("Namensueberlappung "), percent(overlap))),
        (town_hit, 0.10, F.lit("Ortsname im Firmennamen")),
    ]
    total = reduce(lambda x, y: x + y,
                   [F.when(cond, F.lit(v)).otherwise(F.lit(0.0)) for cond, v, _ in parts])
    score = F.bround(F.least(total, F.lit(1.0)), 3)
    reject = (
        F.when(dom == "", F.lit("kein Domain-Treffer"))
        .when((stage == 2) & foreign.isNotNull(), F.concat(
            F.lit("TLD ."), tld, F.lit(" ("), foreign,
            F.lit(") passt nicht zum deutschen Rechtstraeger '"), award_name, F.lit("'")))
        .when(overlap < 0.2, F.concat(
            F.lit("Name passt nicht: '"), F.coalesce(cand_name, F.lit("")), F.lit("' vs. '"), award_name,
            F.lit("' (Ueberlappung "), percent(overlap), F.lit(")")))
    )
    ok = reject.isNull() & (score >= rules.VERIFY_ACCEPT)
    return F.struct(
        ok.alias("accepted"),
        F.when(ok, dom).otherwise(F.lit("")).alias("domain"),
        dom.alias("candidate_domain"),
        F.when(reject.isNull(), score).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(reject.isNull(), stage).otherwise(F.lit(0)).alias("stage"),
        F.when(reject.isNull(), F.concat_ws("; ", *[F.when(c, t) for c, _, t in parts]))
        .otherwise(F.lit("")).alias("signals"),
        F.coalesce(reject, F.when(ok, F.lit("")).otherwise(F.concat(
            F.lit("Confidence "), score.cast("string"), F.lit(" unter Schwelle 0.60")))).alias("reject_reason"),
    )


def verify_imprint(page_text: Column, domain: Column, award_name: Column, award_city: Column) -> Column:
    """Does the imprint text name the awarded company?

    struct(checked, match, confidence_delta, name_ratio, evidence).  A matching name
    alone is not enough: every national subsidiary carries it.
    """
    return let(page_text, lambda page: _imprint(page, domain, award_name, award_city))


def _imprint(page_text: Column, domain: Column, award_name: Column, award_city: Column) -> Column:
    core = F.filter(F.split(company_key(award_name), " "),
                    lambda t: (F.length(t) > 2) & ~t.isin(rules.IMPRINT_STOP_TOKENS))
    town = fold(strip(F.substring_index(award_city, ",", 1)))
    counts = let(F.struct(fold(page_text).alias("hay"), core.alias("core")), lambda x: F.struct(
        F.size(x["core"]).alias("n"),
        F.size(F.filter(x["core"], lambda t: x["hay"].contains(t))).alias("hits"),
        F.coalesce((award_city != "") & x["hay"].contains(town), F.lit(False)).alias("town"),
        register_number(page_text).alias("register")))
    return let(counts, lambda c: _imprint_verdict(
        c["n"], c["hits"], c["town"], c["register"], page_text, domain, award_city))


def _imprint_verdict(n: Column, hits: Column, town_hit: Column, register: Column, page_text: Column,
                     domain: Column, award_city: Column) -> Column:
    ratio = F.when(n > 0, hits / n).otherwise(F.lit(0.0))
    confirmed = (ratio >= 0.6) & (town_hit | F.lower(domain).endswith(".de"))
    refused = (ratio >= 0.6) & ~confirmed
    count = F.concat(F.lit("("), hits.cast("string"), F.lit("/"), n.cast("string"))
    evidence = F.concat_ws(
        "; ",
        F.when(ratio >= 0.6, F.concat(F.lit("Firmenname im Impressum "), count, F.lit(" Tokens)")))
        .when(ratio > 0, F.concat(F.lit("Firmenname nur teilweise "), count, F.lit(")"))),
        F.when(town_hit, F.concat(F.lit("Ort '"), award_city, F.lit("' im Impressum"))),
        F.concat(F.lit("Handelsregister "), register),
        F.when(refused, F.lit("ABGELEHNT: Name passt, aber Ort der Vergabe fehlt im Impressum und Domain "
                              "ist nicht .de - vermutlich eine andere Landesgesellschaft")),
    )
    delta = (F.when(ratio >= 0.6, F.lit(0.45)).when(ratio > 0, F.lit(0.15)).otherwise(F.lit(0.0))
             + F.when(town_hit, F.lit(0.20)).otherwise(F.lit(0.0))
             + F.when(register.isNotNull(), F.lit(0.15)).otherwise(F.lit(0.0)))
    seen = page_text.isNotNull()
    return F.struct(
        seen.alias("checked"),
        (seen & confirmed).alias("match"),
        F.when(seen & ~refused, F.bround(delta, 3)).otherwise(F.lit(0.0)).alias("confidence_delta"),
        F.when(seen, F.bround(ratio, 2)).alias("name_ratio"),
        F.when(~seen, F.lit("Impressum nicht erreichbar"))
        .when(evidence == "", F.lit("keine Uebereinstimmung gefunden")).otherwise(evidence).alias("evidence"),
    )


def to_int(value: Column) -> Column:
    """Counts as people write them: ``1.234``, ``1,234``, ``250-500`` (middle), ``10.000+``, ``1234.0``."""
    s = F.regexp_replace(F.regexp_replace(value.cast("string"), r"\s", ""), r"\++$", "")
    grouped = r"^\d{1,3}(?:[.,]\d{3})+$"

    def plain(c: Column) -> Column:
        whole = F.when(c.rlike(grouped), c).otherwise(F.regexp_replace(c, r"\.\d{1,2}$", ""))
        digits = F.regexp_replace(whole, r"[.,]", "")
        return F.when(digits.rlike(r"^\d{1,18}$"), digits.try_cast("long"))

    parts = F.split(s, "-")
    band = (F.size(parts) == 2) & s.rlike(r"^[\d.,]+-[\d.,]+$")
    middle = F.nullif(F.floor((F.coalesce(plain(parts[0]), F.lit(0)) + F.coalesce(plain(parts[1]), F.lit(0))) / 2)
                      .cast("long"), F.lit(0).cast("long"))
    return F.when(band, middle).otherwise(plain(s))


def head_count_scope(award_name: Column, found_name: Column, country: Column, employees: Column) -> Column:
    """struct(scope, note, usable): is a head count the bidder's own or its group's?"""
    place = strip(F.coalesce(country, F.lit("")))
    other = F.nullif(found_name, F.lit(""))
    flags = F.array_compact(F.array(
        F.when((place != "") & ~F.lower(place).isin(rules.HOME_COUNTRIES), F.concat(
            F.lit("Sitz "), place, F.lit(", Zuschlag ging an deutschen Rechtstraeger"))),
        F.when(employees > rules.MAX_EMPLOYEES, F.concat(
            employees.cast("string"), F.lit(f" MA liegt ueber der ICP-Oberkante {rules.MAX_EMPLOYEES}"))),
        F.when(company_key(other) != company_key(award_name), F.concat(
            F.lit("Name weicht ab: '"), other, F.lit("' vs. Zuschlag '"), award_name, F.lit("'"))),
    ))
    clean = F.size(flags) == 0
    return F.struct(
        F.when(clean, F.lit("rechtstraeger")).otherwise(F.lit("konzern_oder_unklar")).alias("scope"),
        F.array_join(flags, " | ").alias("note"),
        clean.alias("usable"),
    )


def source_rank(source: Column, confidence: Column) -> Column:
    """Quality of a domain entry: its source is the ceiling, its own confidence may only lower it."""
    ceiling = lookup(strip(F.coalesce(source, F.lit(""))), rules.SOURCE_RANK, rules.DEFAULT_SOURCE_RANK)
    return F.least(ceiling, F.coalesce(confidence.cast("string").try_cast("double"), ceiling))


def person_key(profile: Column, email: Column, name: Column, company: Column) -> Column:
    """Identity of a person across exports: profile address, else mail, else name and company."""
    def low(c: Column) -> Column:
        return strip(F.lower(F.coalesce(c, F.lit(""))))
    return F.coalesce(F.nullif(low(profile), F.lit("")), F.nullif(low(email), F.lit("")),
                      F.concat(low(name), F.lit("|"), low(company)))


def filled_count(*cols: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.when(blank_to_null(c).isNotNull(), 1).otherwise(0) for c in cols])
