"""The five messy staging tables, derived from the given test tables.

The rules are deterministic and have every kind of mess the cleaning has to cope with: dates and amounts in many
spellings, keys of several widths and forms, odd letter case and blanks, NULL in disguise, a misspelt cost type,
unknown parents and repeated rows. Which kind a value gets is drawn from a hash of its row's key, by own shares.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leakscope.config import FIXTURE_AS_OF
from leakscope.functions.text import pad_number
from leakscope.operators.copies import append_copies
from leakscope.operators.project import project
from leakscope.sources import schemas

# A multiplicative hash modulo a prime; each multiplier yields three draws of 0 to 255.
_PRIME = 2147483647
_MULTIPLIERS = (1944334129, 1226874159, 950706376, 742938285, 1343714438)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One test table with its declared columns."""
    return spark.read.schema(schemas.TEST_TABLES[name]).parquet(f"{folder}/{name}.parquet")


class _Draws:
    """Independent draws of 0 to 255 for one row, as columns, from the SQL of its number."""

    def __init__(self, number: str):
        self.number, self.made = number, {}

    def __call__(self) -> str:
        group, digit = divmod(len(self.made), 3)
        name = f"_draw_{len(self.made)}"
        self.made[name] = f"(({self.number}) % {_PRIME}) * {_MULTIPLIERS[group]} % {_PRIME} div {256 ** digit} % 256"
        return name

    def project(self, rows: DataFrame, parts: Mapping[str, str], columns: Mapping[str, str]) -> DataFrame:
        """``columns`` of the rows, which name the draws made and the ``parts``.

        Both are columns of a projection below, so each is worked out once a row and generated code has it once: the
        JVM never compiles methods of over 8000 bytes.
        """
        return project(rows.selectExpr("*", *[f"{sql} AS {name}" for name, sql in {**self.made, **parts}.items()]), **columns)


def _kinds(draw: str, *kinds: tuple[int, str], otherwise: str) -> str:
    """The SQL of the first kind whose limit is above the draw."""
    cases = " ".join(f"WHEN {draw} < {limit} THEN {value}" for limit, value in kinds)
    return f"CASE {cases} ELSE {otherwise} END"


def _key(prefix: str, number: str) -> str:
    """A business key in nine digits, six digits or a free form, always the same one for a number."""
    form = f"(({number}) * {_MULTIPLIERS[0]} % {_PRIME} div 1000 % 20)"
    padded = pad_number(number, f"if({form} < 11, 9, 6)")
    return f"concat('{prefix}', if({form} < 17, {padded}, concat('/', {number}, '-x')))"


def _labelled(prefix: str, number: str) -> str:
    return f"concat('{prefix}', {number})"


def _spelled(draw: str, day: str) -> str:
    """A day as text, in one of eleven spellings.

    A lambda is no part of the generated code of a whole stage, which with all spellings in it would be too long for
    the JVM to compile.
    """
    def shown(pattern: str) -> str:
        return f"date_format(_day, '{pattern}')"

    timed = f"concat({shown('yyyy-MM-dd')}, CASE WHEN {draw} < 50 THEN '' WHEN {draw} < 180 THEN ' 08:15' " \
            "ELSE 'T23:05:09.1234567' END)"
    others = _kinds(
        draw, (85, shown("MM/dd/yyyy")), (110, shown("M/d/yyyy")), (140, shown("dd-MMM-yyyy")), (160, shown("yyyyMMdd")),
        (212, shown("yyyy/MM/dd")), (226, shown("MM-dd-yyyy")), (240, shown("MMM d, yyyy")), otherwise=shown("M/d/yy"))
    spelled = f"CASE WHEN {draw} < 50 OR {draw} >= 160 AND {draw} < 196 THEN {timed} ELSE {others} END"
    return f"element_at(transform(array({day}), _day -> {spelled}), 1)"


def _money(draw: str, cents: str) -> str:
    """An amount as text: plain, with dollar sign and commas, between blanks, empty, or no amount at all."""
    whole = f"if({draw} >= 160 AND {draw} < 196, concat('$', format_number({cents} div 100, 0)), cast({cents} div 100 AS string))"
    plain = f"concat({whole}, '.', lpad({cents} % 100, 2, '0'))"
    spelled = f"concat(if({draw} < 196, '', ' '), {plain}, if({draw} < 196, '', '  '))"
    return _kinds(draw, (212, spelled), (226, "''"), (238, "'NULL'"), (248, "'tbd'"), otherwise="NULL")


def stage_policies(customer: DataFrame, as_of: datetime = FIXTURE_AS_OF) -> DataFrame:
    n = "(c_custkey + 11)"
    draw = _Draws(n)
    key, start = "_key", f"date_sub(DATE '{as_of:%Y-%m-%d}', cast({n} * 37 % 1461 AS int))"
    columns = dict(
        policy_number=_kinds(draw(), (24, f"lower({key})"), (48, f"concat({key}, ' ')"), otherwise=key),
        insured_name=_kinds(draw(), (20, "''"), (60, "concat('  ', c_name, ' ')"), otherwise="c_name"),
        lob=_kinds(draw(), (70, "'WC'"), (90, "' wc'"), (110, "'w c'"), (180, "'GL'"), (200, "'gl  '"), (216, "''"),
                   (228, "NULL"), otherwise="'Auto'"),
        effective_date=_spelled(draw(), start),
        expiration_date=_kinds(draw(), (20, "NULL"), (40, "'until cancelled'"), (60, "''"),
                               otherwise=f"date_format(date_add({start}, 364), 'yyyyMMdd')"),
        state=_kinds(draw(), (80, "'IL'"), (120, "' wi '"), (150, "'Wisconsin'"), (190, "'illinois'"), (220, "'IA'"),
                     (240, "'Ohio'"), otherwise="''"),
        broker_code=_kinds(draw(), (16, "'  '"), otherwise=_labelled("BR-", f"{n} % 71")),
    )
    return draw.project(customer, {key: _key("POL", n)}, columns)


def stage_claims(orders: DataFrame, n_adjusters: int | Column) -> DataFrame:
    """Claims, some of them a second time under another spelling of their number.

    ``n_adjusters`` is a number or a one-value subquery such as ``supplier.agg(count).scalar()``.
    """
    n, loss, cents = "(o_orderkey + 5)", "_loss", "_cents"
    draw = _Draws(n)
    size = n_adjusters if isinstance(n_adjusters, Column) else F.lit(n_adjusters)
    key, policy, adjuster = "_key", "_policy_key", "_adjuster_key"
    half = draw()
    columns = dict(
        claim_number=_kinds(draw(), (20, f"lower({key})"), (40, f"concat({key}, '   ')"), (60, f"concat(' ', {key})"),
                            otherwise=key),
        policy_number=_kinds(draw(), (6, _labelled("POL?", "o_custkey")), (30, f"lower({policy})"),
                             (50, f"concat(' ', {policy}, ' ')"), otherwise=policy),
        loss_date=_kinds(draw(), (18, "'NULL'"), (24, "'not known'"), otherwise=_spelled(draw(), loss)),
        report_date=_kinds(draw(), (30, "''"), (40, "NULL"),
                           otherwise=_spelled(draw(), f"date_add({loss}, cast({n} % 17 AS int))")),
        injury_cause=_kinds(draw(), (70, "'Fall'"), (130, "'Strain'"), (180, "' Vehicle '"), (200, "''"),
                            otherwise="'Burn'"),
        body_part=_kinds(half, (80, "'Knee'"), (150, "'Wrist'"), (220, "'Neck'"), otherwise="NULL"),
        claimant_id=_labelled("CT", "o_custkey * 3 + 1"),
        loss_state=_kinds(draw(), (90, "'IL'"), (130, "'wi'"), (160, "'Madison, WI'"), (190, "'Peoria il '"),
                          (220, "'MN'"), (240, "''"), otherwise="NULL"),
        incurred_total=_money(draw(), f"({cents} % 2500000)"),
        paid_total=_money(draw(), f"({cents} div 7 % 900000)"),
        reserve_total=_money(draw(), f"({cents} div 3 % 2100000)"),
        status=f"CASE o_orderstatus WHEN 'O' THEN if({half} < 128, 'open', ' OPEN') "
               f"WHEN 'F' THEN if({half} < 128, 'Closed', 'closed ') ELSE if({half} < 128, 'In suit', NULL) END",
        adjuster_ext_id=_kinds(draw(), (4, "'ADJ-temp'"), (30, f"concat(lower({adjuster}), ' ')"),
                               otherwise=adjuster),
        _again=f"{draw()} < 7",
    )
    claims = draw.project(
        orders.withColumn("_adjuster", (F.col("o_orderkey") + 5) * 13 % size + 3),
        {key: _key("CLM", n), policy: _key("POL", "(o_custkey + 11)"), adjuster: _key("ADJ", "_adjuster"),
         loss: "cast(o_orderdate AS date)", cents: "cast(floor(o_totalprice * 100) AS bigint)"}, columns)
    twice = append_copies(claims, "_again", number="_copy")
    return twice.withColumn("claim_number", F.expr("if(_copy = 1, concat(lower(claim_number), ' '), claim_number)")).drop(
        "_again", "_copy")


def stage_adjuster(supplier: DataFrame, as_of: datetime = FIXTURE_AS_OF) -> DataFrame:
    """Adjusters in a tree of three reports each, some alone in a cycle, some in pairs, some under unknown ones."""
    n = "(s_suppkey + 3)"
    draw = _Draws(n)
    key = "_key"
    hired = f"date_sub(DATE '{as_of:%Y-%m-%d}', cast({n} * 53 % 4000 AS int))"
    above = _key("ADJ", "((s_suppkey - 1) div 3 + 3)")
    columns = dict(
        adjuster_ext_id=_kinds(draw(), (30, f"lower({key})"), (60, f"concat({key}, '  ')"), otherwise=key),
        full_name="s_name",
        hire_date=_kinds(draw(), (25, "''"), otherwise=_spelled(draw(), hired)),
        office=_kinds(draw(), (90, "'Peoria'"), (160, "'Green Bay '"), (220, "'Duluth'"), (235, "''"),
                      otherwise="NULL"),
        supervisor_ext_id=f"CASE WHEN s_suppkey = 0 THEN NULL WHEN s_suppkey % 29 = 17 THEN lower({key}) "
                          f"WHEN s_suppkey % 31 = 20 THEN 'ADJ-gone' "
                          f"WHEN s_suppkey % 37 = 23 THEN {_key('ADJ', '(s_suppkey + 4)')} "
                          f"WHEN s_suppkey % 37 = 24 THEN {_key('ADJ', '(s_suppkey + 2)')} "
                          f"ELSE concat({above}, ' ') END",
    )
    return draw.project(supplier, {key: _key("ADJ", n)}, columns)


def stage_payments(lineitem: DataFrame) -> DataFrame:
    """Payments, about one in sixty of them twice."""
    draw = _Draws("l_orderkey * 8 + l_linenumber + l_partkey * 1009")
    key, shipped, cents = "_key", "_shipped", "_cents"
    cost, check = draw(), "concat('CK', l_partkey)"
    columns = dict(
        payment_ext_id="concat('PAY', l_orderkey, '-', l_linenumber)",
        claim_number=_kinds(draw(), (16, f"lower({key})"), (36, f"concat({key}, '  ')"), (40, f"concat(' ', {key})"),
                            (43, _labelled("CLM#", "l_orderkey")), (45, "NULL"), otherwise=key),
        payment_date=_kinds(draw(), (6, "'pending'"), (9, "NULL"),
                            otherwise=_spelled(draw(), shipped)),
        payee_type=_kinds(draw(), (100, "'provider'"), (160, "'Vendor '"), (200, "'Attorney'"), (230, "'claimant'"),
                          (240, "''"), otherwise="NULL"),
        vendor_id=_kinds(draw(), (30, _labelled("vn", "l_suppkey")), (36, "''"), otherwise=_labelled("VN", "l_suppkey")),
        cost_type=f"CASE l_returnflag WHEN 'A' THEN if({cost} < 128, 'Indemnty', 'indemnty ') "
                  f"WHEN 'N' THEN if({cost} < 200, 'Medical', 'medical') ELSE 'Indemnity' END",
        cost_category=f"CASE WHEN l_linestatus = 'O' THEN 'Other' WHEN {cost} < 60 THEN 'rehab' ELSE 'Treatment' END",
        amount=_money(draw(), cents),
        check_number=_kinds(draw(), (40, f"lower({check})"), (50, "''"), otherwise=check),
        _again=f"{draw()} < 4",
    )
    payments = draw.project(lineitem, {
        key: _key("CLM", "(l_orderkey + 5)"), shipped: "cast(l_shipdate AS date)",
        cents: "cast(floor(l_extendedprice * l_discount * 100) AS bigint)"}, columns)
    return append_copies(payments, "_again").drop("_again")


def stage_notes(events: DataFrame, n_claims: int | Column) -> DataFrame:
    """Notes; the phrases that raise flags are those of the settings, the sentences around them are made up."""
    draw = _Draws("event_id")
    n = n_claims if isinstance(n_claims, Column) else F.lit(n_claims)
    key, iso = "_key", "date_format(ts, 'yyyy-MM-dd')"
    said = draw()
    columns = dict(
        claim_number=_kinds(draw(), (12, f"lower({key})"), (20, f"concat({key}, ' ')"), (24, f"concat(' ', {key})"),
                            otherwise=key),
        note_time=_kinds(draw(), (100, f"concat({iso}, date_format(ts, ' HH:mm'))"), (200, iso),
                         (230, f"concat({iso}, 'T', date_format(ts, 'HH:mm:ss'))"), (240, "'yesterday'"),
                         otherwise="NULL"),
        author=_kinds(draw(), (10, "''"), otherwise=_labelled("adj", "user_id")),
        note_text="CASE event_type "
                  f"WHEN 'signup' THEN CASE WHEN {said} < 128 THEN 'A subrogation claim on the builder was not pursued' "
                  f"WHEN {said} < 200 THEN 'SUBROGATION: Not Pursued, file too old' ELSE 'Subrogation letter sent' END "
                  f"WHEN 'error' THEN CASE WHEN {said} < 128 THEN 'Employer with late FNOL, loss reported after weeks' "
                  f"WHEN {said} < 200 THEN 'LATE FNOL again; Reported After the deadline' ELSE 'Late FNOL is likely' END "
                  f"WHEN 'purchase' THEN if({said} < 180, 'Clinic sent duplicate billing', 'DUPLICATE BILLING twice') "
                  f"WHEN 'click' THEN if({said} < 20, NULL, 'Hearing moved to spring') ELSE 'Spoke with claimant' END",
    )
    numbered = events.withColumn("_claim", F.col("event_id") * 7 % n + 5)
    return draw.project(numbered, {key: _key("CLM", "_claim")}, columns)


class StagedTables(Mapping):
    """The five staging tables of a folder of test tables, each made when asked for."""

    NAMES = ("staged_policies", "staged_claims", "staged_payments", "staged_adjuster", "staged_notes")

    def __init__(self, spark: SparkSession, folder: str, as_of: datetime = FIXTURE_AS_OF):
        self.spark, self.folder, self.as_of = spark, folder, as_of
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)

    def _read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)

    def _spread(self, name: str) -> DataFrame:
        """Rows dealt over tasks before they are spelled out: the test tables have a single row group each, which one
        task would read and clean. Staged files of a deployment need no such step."""
        return self._read(name).hint("rebalance")

    def _size(self, name: str) -> Column:
        """Number of rows as a subquery, which Spark answers from the file footers' row counts."""
        return self._read(name).agg(F.count(F.lit(1)).alias("n")).scalar()

    def _make(self, name: str) -> DataFrame:
        match name:
            case "staged_policies":
                return stage_policies(self._read("customer"), self.as_of)
            case "staged_claims":
                return stage_claims(self._spread("orders"), self._size("supplier"))
            case "staged_payments":
                return stage_payments(self._spread("lineitem"))
            case "staged_adjuster":
                return stage_adjuster(self._read("supplier"), self.as_of)
            case "staged_notes":
                return stage_notes(self._spread("events"), self._size("orders"))
        raise KeyError(name)
