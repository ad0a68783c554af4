"""One-to-one reconciliation: a payment settles one invoice, so a second payment of the same invoice stays unmatched.

Payments are points on an axis (days, or cents) and invoices are intervals around theirs, all of one width, within a
key (an exact amount or day, and optionally a supplier). The result is a maximum matching in which earlier payments go first;
a payment can be matched exactly when the largest matching of the payments up to it grows.

The size of that matching needs no pairs. By Hall's condition the payments left over are the largest sum, over separate stretches
of the axis, of payments in a stretch minus invoices that reach into it. A sweep over the sorted positions carries
three numbers: invoices now in reach, the best sum so far, and the best sum with a stretch still open. Equal positions are one row
with a count. A key's axis is cut into cells; in terms of the last two numbers a cell is a 2 x 2 matrix of the
(max, +) algebra, so cells are swept independently, then chained on their four numbers, then swept again from their
true start. Only cells that an invoice's reach links are chained; any other begins from nothing and is swept once. A hot key is thus many cells, and a cell holds at most three rows per position, however many payments share it.
"""

from datetime import date
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions import fixed_values as fv
from ledgerline.functions import rules as r
from ledgerline.session import shared_dir

#: Positions in a cell: days, or cents.
CELL_DAYS, CELL_CENTS = 512, 5_000
OPENS, PAYMENT, CLOSES = 0, 1, 2
#: Below every sum of counts.
NEVER = -(1 << 60)


def whole(value):
    return F.lit(value).cast("long")


def state(reach, best, running):
    return F.struct(reach.alias("reach"), best.alias("best"), running.alias("running"))


def moved(s, event):
    """The sweep's state after one event. ``best`` counts the payments left over so far."""
    kind, n = event["kind"], event["n"]
    running = F.greatest(s["running"], s["best"]) + n
    return (
        F.when(kind == PAYMENT, state(s["reach"], F.greatest(s["best"], running - s["reach"]), running))
        .when(kind == OPENS, state(s["reach"] + n, s["best"], s["running"]))
        .otherwise(state(s["reach"] - n, s["best"], s["running"] - n))
    )


def swept(events, reach, best, running):
    """The state at the end of a cell."""
    return F.aggregate(events, state(reach, best, running), moved)


def traced(events, reach, best, running):
    """Per payment position: payments, those left over there, and whether any invoice is in reach."""
    start = F.struct(
        state(reach, best, running).alias("s"),
        F.array().cast("array<struct<at:bigint,payments:bigint,left_over:bigint,near:boolean>>").alias("out"),
    )

    def step(acc, event):
        after = moved(acc["s"], event)
        found = F.struct(
            event["at"].alias("at"),
            event["n"].alias("payments"),
            (after["best"] - acc["s"]["best"]).alias("left_over"),
            (acc["s"]["reach"] > 0).alias("near"),
        )
        out = F.when(event["kind"] == PAYMENT, F.concat(acc["out"], F.array(found))).otherwise(acc["out"])
        return F.struct(after.alias("s"), out.alias("out"))

    return F.aggregate(events, start, step, lambda acc: acc["out"])


def counted(points, keys):
    """Rows per distinct point; rows with a null in it are no part of it."""
    known = points.where(" and ".join(f"`{c}` is not null" for c in [*keys, "at"]))
    return known.groupBy(*keys, F.col("at").cast("long").alias("at")).agg(F.count("*").alias("n"))


def match_runs(payments, invoices, keys, slack, width):
    """Payments left over by a maximum one-to-one matching within each key.

    Both sides have the key columns and ``at`` (a whole number); rows with a null in either are no part of it. Gives the
    keys, ``at``, ``payments``, ``left_over`` and ``near`` (an invoice lies within ``slack``) for each position of a payment.
    """
    paid, offered = counted(payments, keys), counted(invoices, keys)

    def event(shift, kind):
        return F.struct((F.col("at") + whole(shift)).alias("at"), F.lit(kind).alias("kind"), "n")

    every = (
        paid.select(*keys, event(0, PAYMENT).alias("event"))
        .unionByName(offered.select(*keys, F.explode(F.array(event(-slack, OPENS), event(slack, CLOSES))).alias("event")))
        .withColumn("cell", F.floor(F.col("event.at") / F.lit(width)).cast("long"))
    )
    kind, n = F.col("event.kind"), F.col("event.n")
    in_reach = F.when(kind == OPENS, n).when(kind == CLOSES, -n).otherwise(whole(0))
    cells = every.groupBy(*keys, "cell").agg(
        F.sort_array(F.collect_list("event")).alias("events"), F.sum(in_reach).alias("gained")
    )
    # both tables are read once: what follows goes over the cells several times
    path = shared_dir(cells.sparkSession, "match-cells")
    cells.write.parquet(path)
    cells = cells.sparkSession.read.schema(cells.schema).parquet(path)

    # where no invoice is in reach at a cell's start the sweep begins anew: only cells of one run depend on each other
    ordered = Window.partitionBy(*keys).orderBy("cell")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    reach = cells.select(*keys, "cell", "gained", F.coalesce(F.sum("gained").over(before), whole(0)).alias("reach"))
    run = F.sum(F.when(F.col("reach") == 0, 1).otherwise(0)).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    linked = reach.withColumn("run", run).where("reach > 0 or reach + gained > 0").drop("gained")
    from_best = swept("events", F.col("reach"), whole(0), whole(NEVER))
    from_running = swept("events", F.col("reach"), whole(NEVER), whole(0))
    effects = cells.drop("gained").join(linked, [*keys, "cell"])
    effects = effects.select(*keys, "run", F.struct("cell", "reach", from_best.alias("b"), from_running.alias("r")).alias("of"))
    chain = effects.groupBy(*keys, "run").agg(F.sort_array(F.collect_list("of")).alias("cells"))

    def link(acc, cell):
        best = F.greatest(acc["best"] + cell["b"]["best"], acc["running"] + cell["r"]["best"])
        running = F.greatest(acc["best"] + cell["b"]["running"], acc["running"] + cell["r"]["running"])
        start = F.struct(
            cell["cell"].alias("cell"), cell["reach"].alias("reach"), acc["best"].alias("best"), acc["running"].alias("running")
        )
        # sums below NEVER stand for "impossible" and must not sink further from cell to cell
        floor = whole(NEVER)
        return F.struct(
            F.greatest(best, floor).alias("best"),
            F.greatest(running, floor).alias("running"),
            F.concat(acc["starts"], F.array(start)).alias("starts"),
        )

    nothing = F.struct(
        whole(0).alias("best"),
        whole(NEVER).alias("running"),
        F.array().cast("array<struct<cell:bigint,reach:bigint,best:bigint,running:bigint>>").alias("starts"),
    )
    starts = chain.select(*keys, F.inline(F.aggregate("cells", nothing, link, lambda acc: acc["starts"])))
    begun = [F.coalesce(F.col(c), whole(fresh)) for c, fresh in (("reach", 0), ("best", 0), ("running", NEVER))]
    return cells.join(starts, [*keys, "cell"], "left").select(*keys, F.inline(traced("events", *begun)))


def cents(column):
    return (F.col(column) * 100).cast("long")


def day_number(column):
    return F.datediff(F.col(column), F.lit(date(1970, 1, 1)))


def axis_of(axis, days, tolerance):
    """Half width and cell width on the axis, and what makes up the key: the other dimension, which must agree exactly."""
    if axis == "days":
        if days < 0 or int(days) != days:
            raise ValueError(f"{days} is no whole number of days")
        return int(days), CELL_DAYS, lambda day, amount: (day_number(day), cents(amount))
    if axis == "amount":
        slack = Decimal(str(tolerance)) * 100
        if slack != int(slack) or slack < 0:
            raise ValueError(f"tolerance of {tolerance} is no whole number of cents")
        return int(slack), CELL_CENTS, lambda day, amount: (cents(amount), day_number(day))
    raise ValueError(axis)


def one_to_one_points(bank, invoices, axis="days", days=fv.RECON_DAYS, tolerance=fv.RECON_AMOUNT, suppliers=None):
    """Debit lines of the ledger against paid invoices, each invoice settled once.

    With ``axis`` "days" the amounts agree to the cent and payment dates lie within ``days``; with "amount" the dates agree
    and the amounts lie within ``tolerance``. ``suppliers`` names the supplier columns of ledger and invoices; without it any
    supplier's invoice will do. Gives day, amount (in cents), supplier, payments, matched, left_over and near per distinct point.
    """
    slack, width, placed = axis_of(axis, days, tolerance)
    bank_supplier, invoice_supplier = suppliers or (None, None)

    def points(df, day, amount, supplier):
        at, other = placed(day, amount)
        named = F.col(supplier) if supplier else F.lit("")
        return df.select(at.alias("at"), other.alias("other"), named.alias("supplier"))

    # rows without a date or an amount have a null in their point and go there: tested here as well, the amount's expression is
    # repeated until the scan's method is too long for the JVM to compile
    paid = invoices.where(r.has_status("PAID"))
    found = match_runs(
        points(bank.where("debit_amount > 0"), "transaction_date", "debit_amount", bank_supplier),
        points(paid, "payment_date", "amount_incl_vat", invoice_supplier),
        ["supplier", "other"],
        slack,
        width,
    )
    day, amount = ("at", "other") if axis == "days" else ("other", "at")
    return found.select(
        *(["supplier"] if suppliers else []),
        F.date_add(F.lit(date(1970, 1, 1)), F.col(day).cast("int")).alias("transaction_date"),
        (F.col(amount).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(r.MONEY).alias("debit_amount"),
        "payments",
        (F.col("payments") - F.col("left_over")).alias("matched"),
        "left_over",
        "near",
    )


def recon_one_to_one(bank, invoices, **how):
    """Payments, matched, unmatched and their share; ``double_paid`` are those left over beside an invoice in reach.

    Debit lines without a date or supplier are payments that match nothing.
    """
    none = whole(0)
    total = bank.where("debit_amount > 0").agg(F.count("*").alias("payments")).select(
        "payments", none.alias("matched"), none.alias("double_paid")
    )
    points = one_to_one_points(bank, invoices, **how)
    beside = F.when(F.col("near"), F.col("left_over")).otherwise(none)
    found = points.select(none.alias("payments"), "matched", beside.alias("double_paid"))
    sums = total.unionByName(found).agg(*[F.sum(c).alias(c) for c in ("payments", "matched", "double_paid")])
    unmatched = F.col("payments") - F.col("matched")
    return sums.select(
        "payments",
        "matched",
        unmatched.alias("unmatched"),
        r.share(unmatched, "payments").alias("unmatched_rate"),
        "double_paid",
    )
