import base64
from decimal import Context, Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom import functions as fn
from changeloom.operators import decode as D
from changeloom.schema import TableSpec

from .conftest import rows

NUMBERS = [
    0, 1, -1, 127, 128, -128, -129, 2**63 - 1, 2**63, -(2**63), -(2**63) - 1, 231532339,
    10**30 + 7, -(10**30) - 7, 10**37 - 1,
]


def _bytes(n):
    return n.to_bytes(max(1, (n.bit_length() + 8) // 8), "big", signed=True)


def test_decimal_bytes_and_base64(spark):
    df = spark.createDataFrame(
        [(str(n), bytearray(_bytes(n)), base64.b64encode(_bytes(n)).decode()) for n in NUMBERS],
        "n string, raw binary, text string",
    )
    for scale in (0, 4, 6):
        got = df.select(
            "n",
            fn.decimal_from_bytes(F.col("raw"), scale).alias("a"),
            fn.decimal_from_base64(F.col("text"), scale).alias("b"),
        ).collect()
        for r in got:
            want = Decimal(r.n).scaleb(-scale, Context(prec=60))
            if abs(want) < Decimal(10) ** (38 - scale):
                assert r.a == want and r.b == want, (r.n, scale)
    example = df.where("n = '231532339'").select(fn.decimal_from_bytes(F.col("raw"))).first()[0]
    assert example == Decimal("23153.2339")


def test_decimal_bytes_out_of_range(spark):
    df = spark.createDataFrame([(bytearray(b"\x7f" * 16),), (bytearray(b"\x01" * 17),), (bytearray(),), (None,)], "raw binary")
    got = [r[0] for r in df.select(fn.decimal_from_bytes(F.col("raw"), 0)).collect()]
    assert got == [None, None, Decimal(0), None]


def test_text_that_is_not_base64_is_kept(spark):
    df = spark.createDataFrame([("12.50",), ("a~",), ("DcznMw==",), (None,)], "v string")
    got = [r[0] for r in df.select(fn.decode_decimal(F.col("v"), T.StringType())).collect()]
    assert got == ["12.50", "a~", "23153.2339", None]
    assert df.select(fn.decode_decimal(F.lit(7), T.IntegerType())).first()[0] == 7


def test_names_and_times(spark):
    df = spark.createDataFrame(
        [("r", "aw.Db.S.T", 1772284201000), ("c", "p.s.t", 0), ("u", "t", None), ("d", "a.b.c.d.e", 1), ("x", "", 1), (None, "t", 1)],
        "op string, topic string, ms long",
    )
    got = df.select(
        fn.op_name(F.col("op")), fn.table_short_name(F.col("topic")), fn.format_ts_ms(F.col("ms"))
    ).collect()
    assert [r[0] for r in got] == ["SNAPSHOT", "INSERT", "UPDATE", "DELETE", "UNKNOWN(x)", "UNKNOWN(?)"]
    assert [r[1] for r in got][:4] == ["T", "p.s.t", "t", "e"]
    assert [r[2] for r in got][:3] == ["2026-02-28 13:10:01", "1970-01-01 00:00:00", "N/A"]
    parts = df.select(fn.topic_parts(F.col("topic")).alias("p")).select("p.*").collect()
    assert tuple(parts[0]) == ("aw", "Db", "S", "T")
    assert tuple(parts[1]) == ("p", None, "s", "t")


def test_wire_header(spark):
    df = spark.createDataFrame(
        [("t", bytearray(b"\x00\x00\x00\x00\x2abody")), ("t", bytearray(b'{"a":1}')), ("t", bytearray(b"\x00\x01")), ("t", None)],
        "topic string, value binary",
    )
    got = D.split_wire_header(df).collect()
    assert [(r.magic_ok, r.schema_id, r.body and bytes(r.body), r.body_size) for r in got] == [
        (True, 42, b"body", 4),
        (False, None, None, None),
        (False, None, None, None),
        (False, None, None, None),
    ]


PERSON = T.StructType(
    [
        T.StructField("BusinessEntityID", T.IntegerType()),
        T.StructField("FirstName", T.StringType()),
        T.StructField("Secret", T.StringType()),
    ]
)
TOPIC = "aw.DB.Person.Person"
META = '"source":{"db":"DB","schema":"Person","table":"Person","commit_lsn":"0000003b:000001e8:0039"},"ts_ms":1772284201000'


def _image(name, secret="s"):
    text = "null" if name is None else f'"{name}"'
    return f'{{"BusinessEntityID":7,"FirstName":{text},"Secret":"{secret}"}}'


def _log(spark, wrapped):
    bodies = [
        f'{{"before":null,"after":{_image("Ann")},{META},"op":"r"}}',
        f'{{"before":{_image("Ann")},"after":{_image("Bea")},{META},"op":"u"}}',
        f'{{"before":{_image("Bea")},"after":{_image("Bea", "z")},{META},"op":"u"}}',
        f'{{"before":null,"after":{_image("Cid")},"op":"u"}}',
        f'{{"before":{_image("Cid")},"after":null,{META},"op":"d"}}',
        None,
        f'{{"before":null,"after":null,{META},"op":"x"}}',
        f'{{"before":null,"after":{_image(None)},{META}}}',
    ]

    def wrap(text):
        return text if text is None or not wrapped else f'{{"schema":{{"type":"struct"}},"payload":{text}}}'

    key = wrap('{"BusinessEntityID":7}')
    data = [(TOPIC, 0, i, key, wrap(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(data, "topic string, partition int, offset long, key string, value string")


@pytest.mark.parametrize("wrapped", [True, False])
def test_decode_and_render(spark, wrapped):
    change = D.decode_json(_log(spark, wrapped), PERSON, wrapped, ["BusinessEntityID"])
    got = change.orderBy("offset").collect()
    assert [r.op for r in got] == ["r", "u", "u", "u", "d", None, "x", None]
    assert [r.pk and r.pk.BusinessEntityID for r in got] == [7] * 8
    assert [r.is_tombstone for r in got] == [False] * 5 + [True, False, False]
    assert {r.table for r in got} == {"Person"}
    lines = [r.summary for r in D.render_summary(change, "Person").orderBy("offset").collect()]
    head = "2026-02-28 13:10:01 | LSN: 0000003b:000001e8:0039 | "
    assert lines[0] == f'[Person] SNAPSHOT | {head}NEW: {{"BusinessEntityID":7,"FirstName":"Ann"}}'
    assert lines[1] == f'[Person] UPDATE | {head}CHANGED: {{"FirstName":"Ann -> Bea"}}'
    assert lines[2] == (
        f'[Person] UPDATE | {head}AFTER: {{"BusinessEntityID":7,"FirstName":"Bea"}}'
        " (no visible changes in display fields)"
    )
    assert lines[3] == (
        '[Person] UPDATE | N/A | LSN: ? | CHANGED: {"BusinessEntityID":"None -> 7","FirstName":"None -> Cid"}'
    )
    assert lines[4] == f'[Person] DELETE | {head}DELETED: {{"BusinessEntityID":7,"FirstName":"Cid"}}'
    assert lines[5] == "[Person] Tombstone message (null value) — used for log compaction"
    assert lines[6] == f"[Person] UNKNOWN(x) | {head}BEFORE: {{}} AFTER: {{}}"
    assert lines[7].startswith("[Person] UNKNOWN(?) | ")


def test_changed_fields_all_columns(spark):
    change = D.decode_json(_log(spark, False), PERSON, False)
    got = {r.offset: r.changed for r in D.changed_fields(change).collect()}
    assert got[2] == {"Secret": "s -> z"}
    assert got[0] is None
    same = D.changed_fields(change, ["BusinessEntityID"]).where("offset = 1").first()
    assert same.changed == {}


def test_unwrap_modes(spark):
    change = D.decode_json(_log(spark, False), PERSON, False)
    rewrite = D.unwrap(change, keep=["offset"]).orderBy("offset").collect()
    assert [r.offset for r in rewrite] == [0, 1, 2, 3, 4, 6, 7]
    assert [r["__deleted"] for r in rewrite][4] == "true"
    assert rewrite[4].FirstName == "Cid"
    drop = D.unwrap(change, deletes="drop", keep=["offset"]).orderBy("offset").collect()
    assert [r.offset for r in drop] == [0, 1, 2, 3, 6, 7]
    none = D.unwrap(change, drop_tombstones=False, deletes="none", keep=["offset"]).orderBy("offset").collect()
    assert len(none) == 8 and none[4].FirstName is None
    with pytest.raises(ValueError):
        D.unwrap(change, deletes="other")


def test_classify(spark):
    change = D.decode_json(_log(spark, False), PERSON, False)
    log = _log(spark, False).join(change.select("offset", "op"), "offset")
    got = D.classify(log).orderBy("offset").collect()
    assert [r.is_unknown_op for r in got] == [False] * 6 + [True, True]
    assert [r.is_tombstone for r in got].index(True) == 5


def test_key_fields_decodes_decimals_by_scale(spark):
    row = "struct<SalesOrderID:int,UnitPrice:binary,LineTotal:binary,Note:string>"
    df = spark.createDataFrame(
        [((1, bytearray(_bytes(125000)), bytearray(_bytes(12500000)), "n"),)], f"after {row}"
    )
    shown = D.key_fields(df, "SalesOrderDetail").first().after_shown
    assert shown.asDict() == {
        "SalesOrderID": 1,
        "UnitPrice": Decimal("12.5000"),
        "LineTotal": Decimal("12.500000"),
    }
    other = D.key_fields(df, "Unlisted").first().after_shown
    assert set(other.asDict()) == {"SalesOrderID", "UnitPrice", "LineTotal", "Note"}
    mine = {"Unlisted": TableSpec("Unlisted", ("SalesOrderID",), ("Note",))}
    assert D.key_fields(df, "Unlisted", specs=mine).first().after_shown.asDict() == {"Note": "n"}


def test_flat_event(spark):
    df = spark.createDataFrame([('{"user_id":"1","name":"n","email":"e","action":"a","timestamp":"t"}',)], "value string")
    assert rows(D.flatten_user_event(df)) == [("1", "n", "e", "a", "t")]
