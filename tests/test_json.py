import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions import jsonvals as V
from tallyframe.functions import text as X
from tallyframe.functions import variants as W
from tallyframe.session import new_table_path
from tallyframe.sources import payloads as S

DOCS = [
    {"Peticion": {"b": {"Nombre": "inner"}, "Nombre": "outer", "lista": [{"q": 1}, {"q": 2}], "Número": 5}},
    {"x": None, "y": [[{"deep": {"Nombre": "far"}}]], "z": []},
    {},
]


def brute_force(doc, key):
    """The reference order: own keys first, then the children in document order."""
    if isinstance(doc, dict):
        if doc.get(key) is not None:
            return doc[key]
        children = list(doc.values())
    elif isinstance(doc, list):
        children = doc
    else:
        return None
    for child in children:
        found = brute_force(child, key)
        if found is not None:
            return found
    return None


def frame(spark):
    texts = [json.dumps(d) for d in DOCS] + ["not json", "", None, '[{"Nombre":"in list"}]']
    return spark.createDataFrame(list(enumerate(texts)), "i int, doc string")


def test_deep_find_small_documents(spark):
    opened = V.with_json_nodes(frame(spark), "doc")
    nodes = F.col("nodes")
    got = opened.orderBy("i").select(
        V.deep_find(nodes, ["Nombre"]), V.deep_find(nodes, ["q"]), V.deep_find(nodes, ["NUMERO"], "folded"),
        V.deep_find(nodes, ["mbre"], "suffix"), V.deep_find(nodes, ["missing", "q"]),
    ).collect()
    assert [r[0] for r in got] == ["outer", "far", None, None, None, None, "in list"]
    assert [r[1] for r in got] == ["1", None, None, None, None, None, None]
    assert [r[2] for r in got][:2] == ["5", None]
    assert [r[3] for r in got][0] == "outer"
    assert [r[4] for r in got][0] == "1"


def test_deep_find_against_brute_force(spark):
    """Nested documents made by rule, every key looked up in both ways."""
    def make(seed, depth):
        node = {}
        for n in range(3):
            name = f"k{(seed * 7 + n * 3 + depth) % 5}"
            if depth and (seed + n) % 2:
                node[name] = make(seed * 3 + n, depth - 1)
            elif depth and (seed + n) % 3 == 0:
                node[name] = [make(seed + n + 1, depth - 1), seed]
            else:
                node[name] = f"v{seed}-{n}"
        return node

    docs = [make(i, 3) for i in range(60)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, doc string")
    opened = V.with_json_nodes(df, "doc")
    keys = [f"k{n}" for n in range(5)]
    got = opened.select("i", *[V.deep_find(F.col("nodes"), [k]).alias(k) for k in keys]).collect()
    for r in got:
        for k in keys:
            want = brute_force(docs[r["i"]], k)
            if isinstance(want, str) or want is None:
                assert r[k] == want, (r["i"], k)
            else:
                assert json.loads(r[k]) == want


def test_found_fields_agree_with_deep_find(spark):
    opened = V.with_json_nodes(frame(spark), "doc")
    found = V.found_fields(opened, "nodes", ["i"], [V.Field("c", ("NOMBRE",))])
    first = found.groupBy("i").agg(F.min_by("value", F.struct("rank", "position")).alias("v"))
    want = opened.select("i", V.deep_find(F.col("nodes"), ["nombre"], "folded").alias("v")).filter("v is not null")
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, want.collect()))


def test_opening_is_not_repeated_by_filters(spark):
    opened = V.with_json_nodes(frame(spark), "doc")
    found = opened.select("i", V.deep_find(F.col("nodes"), ["Nombre"]).alias("n"))
    plan = found.filter("n is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == found._jdf.queryExecution().optimizedPlan().toString().count("from_json")


def test_envelope(spark):
    payloads = [
        '{"detalle":{"Table":[{"A":1,"cf":{"x":"y"}},{"A":null}]}}', '{"detalle":{"Table":[]}}', "{}", "bad", None,
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "raw string")
    got = S.json_envelope_records(df, "raw", ["detalle", "Table"], {"a": "A", "x": "cf.x", "none": "Z"}).collect()
    assert [tuple(r) for r in got] == [("1", "y", None), (None, None, None)]


def test_inferred_schema_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, '{"a":1}'), (2, '{"b":{"c":"x"}}'), (3, "bad"), (4, '{"n":null}')], "i int, j string")
    got = S.json_column_infer(df, "j").orderBy("i")
    assert got.columns == ["i", "j", "doc"]
    assert [r["doc"]["a"] if r["doc"] else None for r in got.collect()][:2] == [1, None]
    assert got.filter("doc.b.c = 'x'").count() == 1


def test_json_chain_survives_gaps(spark):
    inner = json.dumps({"y": json.dumps({"z": "deep"})})
    df = spark.createDataFrame([(json.dumps({"x": inner}),), ('{"x":"no json"}',), ("bad",)], "raw string")
    got = S.json_chain(df, "raw", [("a", "raw", "x STRING"), ("b", "a.x", "y STRING"), ("c", "b.y", "z STRING")])
    assert [r[0] for r in got.select("c.z").collect()] == ["deep", None, None]


def test_array_values(spark):
    df = spark.createDataFrame([([],), (["a", None, "b"],), (None,)], T.StructType([T.StructField("v", T.ArrayType(T.StringType()))]))
    got = df.select(V.array_first_or_join(F.col("v")), V.array_first_or_join(F.col("v"), True), V.array_empty_default(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(None, None, "0"), ("a, b", "a", '["a",null,"b"]'), (None, None, None)]


def test_unwrapped_values(spark):
    texts = ['{"a":null,"b":{"c":"x"}}', '[{"a":1},{"b":[]},["y"]]', "[]", " plain , t ", "{}", None, "[a, b]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string").orderBy("i")
    df = df.select(F.explode(F.array(V.unwrap_value(F.col("v")))).alias("v"))
    got = df.select(X.list_text_normalize(F.col("v")), X.list_text_normalize(F.col("v"), True)).collect()
    assert [r[0] for r in got] == ["x", "1, y", None, "plain, t", None, None, "a, b"]
    assert [r[1] for r in got][1] == "1"


def nested(depth, value, name="e"):
    """An object inside objects and lists, with an empty object before each way down."""
    doc = {name: value}
    for n in range(depth):
        doc = {"void": {}, f"d{n}": [[], doc] if n % 3 == 2 else doc}
    return doc


def test_any_depth(spark):
    depths = [0, 1, 3, 4, 5, 8, 12, 30]
    texts = [json.dumps({**nested(n, f"deep{n}"), "z": "1"}) for n in depths] + ["{" * 5, '{"a":"[{"}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, doc string")
    opened = V.with_json_nodes(df, "doc").select("i", V.deep_find(F.col("nodes"), ["e"]).alias("e"))
    got = opened.join(df.select("i", V.first_scalar(F.col("doc")).alias("first"), V.unwrap_value(F.col("doc")).alias("whole")), "i").orderBy("i").collect()
    for r, n in zip(got, depths):
        assert r.e == r.first == r.whole == f"deep{n}"


def test_first_value_skips_what_is_empty(spark):
    docs = ['{"a":{},"b":[null,[]],"c":[{"x":null},{"y":[[["v"]]]}],"d":"later"}', "[[],{}]", "plain", None, '{"a":null}']
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    assert [r[0] for r in df.select(V.first_scalar(F.col("d"))).collect()] == ["v", None, "plain", None, None]


def test_fields_by_alias_name_and_ending(spark):
    fields = [V.Field("a", ("Alias", "DI_Nombre", "Nombre")), V.Field("b", ("CóDigo",), by_ending=True), V.Field("c", ("missing",))]
    docs = ['{"nombre":"n","x":{"ALIAS":"al"},"otro_codigo":"e"}', '{"di_nombre":"d","deep":[{"codigo":"whole","mi_codigo":"tail"}]}', '{"z":1}', None]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, doc string")
    got = V.found_fields(V.with_json_nodes(df, "doc"), "nodes", ["i"], fields).collect()
    assert {(r.i, r.column, r["rank"], r.value) for r in got} == {
        (0, "a", 2, "n"), (0, "a", 0, "al"), (0, "b", 1, "e"), (1, "a", 1, "d"), (1, "b", 0, "whole"), (1, "b", 1, "tail"),
    }


def random_document(rnd, depth):
    kind = rnd.random()
    names = ["b", "a", "Número", "c x", 'q"t', "n", "é\\n", "", "123456789q"]
    if depth and kind < 0.4:
        return {k: random_document(rnd, depth - 1) for k in rnd.sample(names, rnd.randrange(5))}
    if depth and kind < 0.6:
        return [random_document(rnd, depth - 1) for _ in range(rnd.randrange(4))]
    if depth and kind < 0.65:
        return json.dumps(random_document(rnd, 2))
    return rnd.choice([None, "v", "", " {", "[1,2", 'a"b\\c', "123456789x", 1, 1.5, True, "é日", "line\nbreak", -2.25])


def plain_nodes(doc, path=()):
    """(holder, place, name, value) of every named value, read with the standard library; text inside that is JSON is opened."""
    if isinstance(doc, str) and doc.lstrip()[:1] in ("{", "["):
        try:
            doc = json.loads(doc)
        except ValueError:
            return
    if isinstance(doc, dict):
        entries = [(k, v) for k, v in doc.items()]
    elif isinstance(doc, list):
        entries = [(None, v) for v in doc]
    else:
        return
    for i, (k, v) in enumerate(entries):
        if v is not None:
            if k is not None:
                yield path, i, k, v
            yield from plain_nodes(v, (*path, i))


def test_nodes_in_match_order(spark):
    """Names, order and values of random documents, stored as variants and read again."""
    rnd = random.Random(11)
    docs = [random_document(rnd, 5) for _ in range(400)] + [nested(12, "far")]
    df = spark.createDataFrame([(i, json.dumps(d, ensure_ascii=i % 2 == 0, indent=i % 3 or None)) for i, d in enumerate(docs)], "i int, doc string")
    path = new_table_path(spark, "variants")
    W.with_document(df, "doc").drop("doc").write.parquet(path)
    got = W.with_nodes(spark.read.parquet(path), "document").select("i", F.transform("nodes", lambda n: F.struct(n["key"], n["value"])).alias("n"))
    for r in got.collect():
        doc = json.loads(json.dumps(docs[r.i]))
        want = sorted(plain_nodes(doc), key=lambda n: n[:2])
        assert [n[0] for n in r.n] == [k for _, _, k, _ in want], docs[r.i]
        for (_, text), (*_, v) in zip(r.n, want, strict=True):
            if isinstance(v, (dict, list)):
                assert json.loads(text) == v
            else:
                assert text == (v if isinstance(v, str) else json.dumps(v))


def test_broken_and_doubled_names(spark):
    """Equal names are both there; what follows a whole document is ignored, as JSON functions do."""
    texts = ['{"a":1,"a":2}', '{"a":1}"', '{"a', "", None, "7", '{"000000001a":{"000000002b":"000000003{"}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, doc string")
    got = W.with_nodes(W.with_document(df, "doc"), "document").orderBy("i").select(F.transform("nodes", lambda n: F.struct(n["key"], n["value"])).alias("n"))
    assert [[tuple(x) for x in r.n] for r in got.collect()] == [
        [("a", "1"), ("a", "2")], [("a", "1")], [], [], [], [], [("000000001a", '{"000000002b":"000000003{"}'), ("000000002b", "000000003{")],
    ]


def test_a_catalogue_of_any_length_is_one_join(spark):
    """The plan of a search does not grow with the fields, and every field finds its value."""
    docs = [json.dumps({"s": {f"Campo{n}": f"v{n}" for n in range(0, 600, 3)}, "Mi_Final7": "e"})]
    df = W.with_document(spark.createDataFrame([(1, docs[0])], "i int, doc string"), "doc")

    def search(n):
        fields = [V.Field(f"c{k}", (f"campo{k}",)) for k in range(n)] + [V.Field(f"f{k}", (f"final{k}",), by_ending=True) for k in range(12)]
        return W.wanted_fields(df, "document", ["i"], fields)

    sizes = [search(n)._jdf.queryExecution().optimizedPlan().toString().count("lambda") for n in (20, 600)]
    assert sizes[0] == sizes[1]
    got = {(r.column, r.value) for r in search(600).collect()}
    assert got == {(f"c{k}", f"v{k}") for k in range(0, 600, 3)} | {("f7", "e")}


def test_lists_and_plain_values_of_variants(spark):
    texts = ['[{"a":1},{"b":[]},["y"]]', '"[a, b]"', '"[\\"p\\",null]"', '{"a":null,"b":{"c":"x"}}', '"plain"', "[]", "3.5", "null"]
    df = W.with_document(spark.createDataFrame(list(enumerate(texts)), "i int, doc string"), "doc").orderBy("i")
    tree, opens = F.col("document.tree"), F.col("document.opens")
    got = df.select(W.listed(tree, opens).alias("l"), W.first_plain(tree, opens).alias("p")).collect()
    assert [r.l for r in got] == [["1", "y"], ["a", "b"], ["p"], None, None, [], None, None]
    assert [r.p for r in got] == ["1", None, "p", "x", "plain", None, "3.5", None]


def test_inferred_documents_are_parsed_once(spark):
    texts = ['{"a":1,"b":{"c":"x"},"l":[1,2]}', '{"a":2.5,"b":{"d":null}}', "bad", None, '{"n b":true}']
    df = S.json_column_infer(spark.createDataFrame(list(enumerate(texts)), "i int, j string"), "j")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "parse_json" not in plan
    got = {r.i: r.doc for r in df.select("i", "doc").collect()}
    assert got[0]["b"]["c"] == "x" and got[0]["l"] == [1, 2] and float(got[1]["a"]) == 2.5 and got[4]["n b"] is True and got[3] is None
    none = S.json_column_infer(spark.createDataFrame([(1, "bad")], "i int, j string"), "j")
    assert none.columns == ["i", "j", "doc"] and none.count() == 1
