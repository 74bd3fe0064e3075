"""Small random tables full of the cases generic data does not have.

Orders shared by several members, orders and members without ids, equal payment times, one
member and one order holding a third of all rows, zero and unknown quantities and amounts,
unknown lines, SKUs missing from the master, members joining after the report date.
"""

import datetime as dt
import random
from decimal import Decimal

from shelfmark.sources.tables import SCHEMAS

LINES = ["Brand#1", "Brand#12", "Brand#3", "Brand#4", "Brand#5", None]


def make_tables(seed):
    rng = random.Random(seed)

    def pick(*values):
        return rng.choice(values)

    days = [dt.date(2000, 1, 3) + dt.timedelta(days=rng.randrange(0, 560)) for _ in range(14)]
    days += [dt.date(2001, 1, 1), dt.date(2001, 6, 30), dt.date(2001, 7, 1), dt.date(2000, 7, 3), dt.date(2000, 7, 4)]
    marks = ["1 1/2", "1 1/2+", "1/2", "18+", " 6-12 ", "all ages", "", None, "13+", "9+"]
    prices = [None if p is None else Decimal(p) for p in ("0", "299.99", "300", "800", "-1", None, "500")]
    launches = [None, dt.date(2001, 2, 1), dt.date(2000, 12, 27), dt.date(1999, 12, 28), dt.date(1998, 1, 1)]

    product = []
    for i in range(24):
        launch = pick(*launches)
        product.append((f"s{i}", f"SKU {i}", pick(*LINES), pick(*marks), pick(*prices), launch, pick(launch, *launches)))
    master = {p[0]: p for p in product}
    members = [str(i) for i in range(1, 18)]
    bridge = [(1000 + i, str(i)) for i in range(1, 18) if i % 5]

    order_lines = []
    for i in range(420):
        hot = rng.random() < 0.33
        order = "o-hot" if rng.random() < 0.1 else pick(None, *[f"o{j}" for j in range(90)])
        sku = pick("s-unknown", *master)
        stamp = dt.datetime.combine(pick(*days), dt.time(pick(0, 9, 9, 21)))
        line = master[sku][2] if sku in master else pick(*LINES)
        order_lines.append(
            (
                stamp + dt.timedelta(seconds=pick(0, 0, 1)),
                stamp,
                pick("CRM", "CRM", "DY", "TM", "ANON", None),
                pick("x1", "x2", "x3", None),
                order,
                sku,
                pick(line, line, *LINES),
                pick(1.0, 2.0, 2.0, -1.0, 0.0, None),
                pick(True, True, True, False, None),
                pick(True, True, True, False, None),
                pick(None, Decimal("10.00"), Decimal("25.50"), Decimal("-3.00"), Decimal("7.25")),
                pick("STORE", "STORE", "STORE", "WEB_A", "OTHER"),
                pick(1, 1, 1, 3, None),
                pick("normal", "normal", "refund", None),
                pick("Tier 1", "Tier 2", "Tier 6", None),
                pick("north", "south", "west", None),
                "7" if hot else pick(None, "nobody", *members),
            )
        )
    store_sales = []
    for paid in order_lines:
        if paid[11] == "STORE" and paid[12] == 1:
            day, p = paid[1].date(), master.get(paid[5])
            store_sales.append(
                (
                    paid[4], paid[5], p and pick(p[1], p[1], p[1] + " new"), paid[6], day.isoformat(), day,
                    paid[7], paid[10], p and p[5], p and p[6],
                )
            )
    member = [
        (
            str(key), dt.datetime(*pick((1999, 8, 1), (2000, 2, 1), (2000, 7, 3), (2001, 3, 1), (2001, 8, 1))),
            pick("STORE-APP", "STORE", "WEB", None), pick("gold", None), pick(0, 1, 2, None),
            pick(None, dt.date(1950, 5, 5), dt.date(1980, 1, 1), dt.date(1990, 1, 1)),
            pick(None, dt.date(1980, 1, 1)), pick(0, 1, None),
        )
        for key, _ in bridge
    ]
    history = [
        (str(1000 + rng.randrange(1, 18)), pick(1970, 1984, 1990, 1994, 1998, 2001, None), pick(1, 2, 2))
        for _ in range(25)
    ]
    plan = [
        (pick("s-unknown", *master), pick(2000, 2001, 2001), rng.randrange(1, 13), pick(None, 0, 5, 9),
         pick("WEB", "STORE", "STORE,WEB", None), pick("DP02", "DP03", "DP03"))
        for _ in range(150)
    ]
    tables = {
        "product": product,
        "order_lines": order_lines,
        "store_sales": store_sales,
        "member_bridge": bridge,
        "member": member,
        "birthday_history": history,
        "store": [("north",), ("south",), ("south",)],
        "city_type": [("north", "1_mature"), ("west", "2_core")],
        "sku_plan": plan,
    }
    return tables


def to_spark(spark, tables):
    return {n: spark.createDataFrame(rows, SCHEMAS[n]).repartition(3) for n, rows in tables.items()}


def to_duckdb(connection, tables):
    types = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "int": "INTEGER"}
    for name, rows in tables.items():
        fields = [f.strip().split(" ") for f in SCHEMAS[name].replace("(18,2)", "(18;2)").split(",")]
        columns = ", ".join(f"{n} {types.get(t, t.replace(';', ','))}" for n, t in fields)
        connection.execute(f"CREATE TABLE edge_{name} ({columns})")
        marks = ", ".join("?" for _ in fields)
        if rows:
            connection.executemany(f"INSERT INTO edge_{name} VALUES ({marks})", rows)
    connection.execute(
        """CREATE VIEW edge_member_view AS SELECT *, CAST(join_time AS DATE) AS join_date,
        beneficiary_birthday IS NOT NULL AS has_beneficiary_birthday FROM edge_member"""
    )
    connection.execute(
        """CREATE VIEW edge_order_lines_view AS SELECT o.*, p.sku_name, p.bu_launch_date, p.store_launch_date
        FROM edge_order_lines o LEFT JOIN edge_product p ON o.sku_id = p.sku_id"""
    )
