"""Fixture rows."""

import json

FIELDS = (
    "transaction_id", "customer_id", "account_id", "amount", "currency",
    "transaction_type", "merchant", "location", "timestamp", "status",
)


DAY = "2027-03-08T"


def tx(i="T1", customer="C1", account="A1", amount=10.0, currency="INR", kind="UPI",
       merchant="Shop", location="Here", at=DAY + "14:00:00", status="SUCCESS"):
    return (i, customer, account, amount, currency, kind, merchant, location, at, status)


# Three good rows, one of them high; three broken ones; six of a customer within five minutes.
DAILY = [
    tx("A-1", "ann", "a/ann", 412.5, kind="IMPS", at=DAY + "08:10:00"),
    tx("A-2", "bob", "a/bob", 99.0, kind="CARD", at=DAY + "08:11:07"),
    tx("A-3", "cyd", "a/cyd", 180500.0, kind="NEFT", at=DAY + "08:12:14"),
    tx("A-4", None, "a/dee", 33.0, at=DAY + "08:13:21"),
    tx("A-5", "eve", "a/eve", 61.0, kind="BARTER", at=DAY + "08:14:28", status="LOST"),
    tx("A-6", "fay", "a/fay", -7.0, at=DAY + "08:15:35"),
] + [tx(f"V-{n}", "ann", "a/ann", 11.0 + n, kind="ATM" if n % 2 else "UPI", at=f"{DAY}09:2{n // 2}:{11 + n}")
     for n in range(6)]
REPEATED = [tx(f"R-{n}", f"r{n}", amount=20.0 + n, at=f"{DAY}10:3{n}:00") for n in (1, 2, 1, 3, 2)]
STREAM_1 = [tx(f"S-{n}", f"s{n}", amount=x, at=f"{DAY}11:0{n}:00") for n, x in enumerate((70.0, 130000.5, 71.0))]
STREAM_2 = [tx(f"S-{n}", f"s{n}", amount=x, at=f"{DAY}11:0{n}:30") for n, x in ((3, 100000.5), (4, 72.0))]


def as_lines(rows):
    return "\n".join(json.dumps(dict(zip(FIELDS, row))) for row in rows) + "\n"


def write_lines(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(as_lines(rows))
    return str(folder)
