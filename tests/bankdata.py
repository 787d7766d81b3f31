"""Two customers, two accounts, sixteen transactions."""

import datetime as dt

from tidecast import schemas as S
from tidecast.sources.bank import Bank


def frame(spark, schema, records):
    data = [tuple(r.get(f.name) for f in schema) for r in records]
    return spark.createDataFrame(data, schema)


def transactions():
    out = []
    for base, account in ((100.0, "ACC0000001"), (200.0, "ACC0000002")):
        for i in range(8):
            out.append(
                {
                    "transaction_id": f"TX{account[-1]}{i:04d}",
                    "account_id": account,
                    "transaction_type": "deposit" if i % 2 == 0 else "withdrawal",
                    "amount": base + 50.0 * i,
                    "transaction_date": dt.date(2015, i + 1, 15),
                    "status": "completed",
                }
            )
    return out


def bank(spark) -> Bank:
    people = [("CUST000001", "retail", "Male"), ("CUST000002", "premium", "female")]
    customers = [
        {
            "customer_id": cid,
            "dob": dt.date(1980, 1, 1),
            "gender": gender,
            "account_open_date": dt.date(2010, 1, 1),
            "customer_segment": kind,
            "branch_code": "BR001",
        }
        for cid, kind, gender in people
    ]
    accounts = [
        {"account_id": f"ACC000000{i}", "customer_id": f"CUST00000{i}", "balance": b, "account_status": "active"}
        for i, b in ((1, 5000.0), (2, 12000.0))
    ]
    loans = [{"loan_id": "L1", "customer_id": "CUST000002", "loan_status": "active"}]
    branches = [{"branch_code": "BR001", "city": "Melbourne"}]
    return Bank(
        frame(spark, S.CUSTOMERS, customers),
        frame(spark, S.ACCOUNTS, accounts),
        frame(spark, S.LOANS, loans),
        frame(spark, S.BRANCHES, branches),
        frame(spark, S.TRANSACTIONS, transactions()),
    )


__all__ = ["bank", "frame", "transactions"]
