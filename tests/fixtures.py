"""Small synthetic notices covering every outcome."""

import datetime as dt
import json

AS_OF = dt.date(2026, 9, 27)


def org(name, oid=None, city=None, plz=None):
    return {"id": oid, "name": name, "address": {"locality": city, "postalCode": plz}}


def release(i, date, code="72000000", tenderers=(), winners=(), n=None, tag=("tender",), lots=(), deadline=None, **more):
    awards = [{"id": f"A{i}", "date": more.get("award_date"), "relatedLots": [x["id"] for x in lots],
               "value": {"amount": 10.5, "currency": "EUR"}, "suppliers": list(winners)}] if winners else []
    return {"id": i, "ocid": more.get("ocid", f"ocds-{i}"), "date": date, "tag": list(tag),
            "buyer": {"name": more.get("buyer", "Stadt Bonn"), "address": {"locality": "Bonn"}},
            "tender": {"title": f"Verfahren {i}", "classification": {"id": code} if code else None,
                       "items": more.get("items", []), "numberOfTenderers": n, "lots": list(lots),
                       "tenderPeriod": {"endDate": deadline} if deadline else None, "tenderers": list(tenderers),
                       "value": {"amount": 99.0}},
            "awards": awards, "parties": more.get("parties", [])}


def lot(i, end):
    return {"id": i, "contractPeriod": {"endDate": end}}


RELEASES = [
    release("n1", "2026-09-01T10:00:00+02:00", winners=[org("Alpha GmbH", "O1", "Bonn", "53111")],
            tenderers=[org("Alpha GmbH"), org("Beta AG", "O2", "Köln")], lots=[lot("L1", "2027-05-01")], tag=["award"]),
    release("n2", "2026-09-05", tenderers=[org("Beta AG")], n=1, tag=["award"], lots=[lot("L1", "2027-04-20")]),
    release("n3", "2026-09-07", tenderers=[org("Beta AG"), org("Gamma KG")], buyer="Land"),
    release("n4", "2026-08-01", winners=[org("ARGE Alpha GmbH / Delta SE", "O4")], tag=["award"], award_date="2026-07-30"),
    release("n5", "2026-09-10", code="31000000", winners=[org("Epsilon GmbH")]),
    release("n6", "2026-09-20", deadline="2026-10-15T12:00:00Z"),
    release("n7", "2026-09-21"),
    release("n8", "2026-09-12", winners=[org("Dataport"), org("Auftragnehmer")], tag=["award"]),
    release("n9", "2026-09-02T10:00:00+02:00", ocid="ocds-n2", tenderers=[org("Beta AG")], n=1, tag=["award"]),
]


def write_documents(folder, releases=RELEASES, broken=False):
    """The three document shapes and, if asked, a broken one."""
    (folder / "package.json").write_text(json.dumps({"releases": releases[:4]}))
    (folder / "list.json").write_text(json.dumps(releases[4:-1]))
    (folder / "single.json").write_text(json.dumps(releases[-1]))
    if broken:
        (folder / "broken.json").write_text('{"releases": [')
    return str(folder)
