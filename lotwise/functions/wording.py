"""Reason-to-call sentences.  Each quotes the concrete artefact, never a category."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lotwise.functions.dates import german_date
from lotwise.functions.text import blank_to_null, strip

TITLE_CUT = 110


def why_now(signal_type: Column, title: Column, buyer: Column, org_name: Column, place: Column,
            day: Column, contract_end: Column, days_to_deadline: Column) -> Column:
    short = F.coalesce(F.nullif(F.substring(strip(title), 1, TITLE_CUT), F.lit("")), F.lit("dem Verfahren"))
    who = F.coalesce(F.nullif(buyer, F.lit("")), F.nullif(org_name, F.lit("")), F.lit("der Vergabestelle"))
    when = german_date(day)
    where = F.coalesce(F.concat(F.lit(", Standort "), blank_to_null(place)), F.lit(""))
    left = F.coalesce(days_to_deadline.cast("string"), F.lit("wenigen"))
    # Fixed wording per signal type; text and values alternate.
    sentences = {
        "rahmenvertrag_laeuft_aus": [
            "Ihr Rahmenvertrag „", short, "“ mit ", who, " endet am ", german_date(contract_end),
            " — die Neuausschreibung startet erfahrungsgemäß rund sechs Monate vorher."],
        "nachpruefung_vergabekammer": [
            "Sie haben im Verfahren „", short, "“ ein Nachprüfungsverfahren angestrengt (", when,
            ") — häufig liegt die Ursache in einem Eignungs- oder Ausschlusskriterium, "
            "das erst spät im Dokument auftaucht."],
        "offene_ausschreibung_im_profil": [
            who, " hat „", short, "“ ausgeschrieben, Abgabefrist in ", left,
            " Tagen — passt auf Ihr CPV-Profil."],
        "zuschlag_gewonnen": [
            "Sie haben am ", when, " den Zuschlag für „", short, "“ (", who,
            ") erhalten — im selben CPV-Segment laufen aktuell weitere Verfahren."],
        "bid_rolle_ausgeschrieben": [
            "Sie suchen seit ", when, " eine Verstärkung im Angebotsmanagement (", short, where,
            ") — das Verfahrensvolumen wächst offenbar schneller als das Team."],
    }
    out = None
    for kind, parts in sentences.items():
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
        out = F.when(signal_type == kind, text) if out is None else out.when(signal_type == kind, text)
    return out.otherwise(F.concat(F.lit("Signal "), F.coalesce(signal_type, F.lit("")), F.lit(" vom "),
                                  when, F.lit(".")))
