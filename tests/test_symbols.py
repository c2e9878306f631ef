"""Hand-written sources. Expected values follow the grammar, not the implementation."""

import json

import pytest

from tessella.operators import symbols as S


@pytest.fixture
def listed(spark):
    """Symbols of one source by name."""

    def run(code, mode="compat"):
        rows = S.symbols(spark.createDataFrame([(1, code)], "file_id long, code string"), mode=mode)
        return {r.symbolName: r for r in rows.orderBy("pos", "ord").collect() if r.symbolName is not None}

    return run


def test_types_with_attributes_and_conformances(listed):
    got = listed(
        "@objc\n@available(iOS 13, *)\npublic final class Outer<T: Hashable>: Base<T, Int>, Proto where T: Codable {\n"
        "  struct Inner {}\n  class func make() {}\n}\nenum E: Int { case a }\nextension Outer: Other {}\n"
        "protocol Only: class {}\n"
    )
    assert list(got) == ["Outer", "Inner", "make(())"]
    assert got["Outer"].conforms == ["Base<T, Int>", "Proto"]
    assert got["Outer"].attributes == ["@objc", "@available"]
    assert (got["Outer"].symbolKind, got["Inner"].symbolKind) == ("class", "struct")
    assert got["Inner"].conforms == [] and got["Inner"].attributes == []


NESTED = """
class A {
  var x: Int = 1
  class B {
    let y = 2
    func f() { let local = 3 }
  }
}
let g = 4
"""


def test_compat_never_qualifies(listed):
    got = listed(NESTED)
    assert list(got) == ["A", "x", "B", "y", "f(())", "local", "g"]
    assert {r.symbolKind for n, r in got.items() if n in ("x", "y", "local", "g")} == {"variable"}


def test_qualified_names(listed):
    got = listed(NESTED, "qualified")
    assert list(got) == ["A", "A.x", "A.B", "A.B.y", "A.B.f(())", "A.B.local", "g"]
    assert got["A.x"].symbolKind == "property" and got["g"].symbolKind == "variable"


def test_unknown_mode(listed):
    with pytest.raises(ValueError):
        listed(NESTED, "other")


def test_bindings(listed):
    got = listed(
        "var a: Int = 1, b = 2, c: String\nlet (p, q) = (1, 2)\nprivate(set) lazy var d: Dictionary<String, Int> = [:]\n"
        "if let e = f, let h = i { }\nguard case let j = k else { }\nlet m = [1, 2], n = g(3, 4)\n"
    )
    assert list(got) == ["a", "b", "c", "d", "m", "n"]
    assert [got[n].typeSignature for n in "abc"] == ["Int"] * 3  # the first binding's type
    assert got["d"].typeSignature == "Dictionary<String, Int>"
    assert got["m"].typeSignature == ""


def test_signatures(listed):
    got = listed(
        "func plain() {}\nfunc full<T: P>(_ a: Int = 3, then cb: @escaping (T) -> Void) async throws -> [String: T] where T: Q {}\n"
        "protocol R { func need(x: Int) -> Bool\n  func other() }\nfunc == (l: A, r: A) -> Bool { l.id == r.id }\n"
        "func spread(\n  a: Int,\n  b: Int\n) -> Int { a }\n"
    )
    sig = "(_ a: Int = 3, then cb: @escaping (T) -> Void) async throws -> [String: T]"
    assert got[f"full({sig})"].typeSignature == sig
    assert got["need((x: Int) -> Bool)"].calls_out == []
    assert "plain(())" in got and "other(())" in got and "==((l: A, r: A) -> Bool)" in got
    assert "spread((\n  a: Int,\n  b: Int\n) -> Int)" in got


def test_calls_and_references(listed):
    got = listed(
        "func f(input: Int) {\n  let items: [Int] = load(from: path)\n  guard let first = items.first, ok else { return }\n"
        "  items.map { $0.value }.forEach { item in\n    show(item, separator: sep)\n  }\n"
        "  queue.async { [weak self] in\n    self?.reload()\n  }\n  for (i, v) in pairs { total(i + v) }\n"
        "  if first.ready { done() }\n  switch kind { case .one(let k): use(k)\n  default: break }\n"
        "  return super.finish(x) as? Target ?? Box<Elem>(1)\n}\n"
    )
    f = got["f((input: Int))"]
    assert f.calls_out == sorted("load map forEach show async reload total done one use finish".split())
    assert f.references == sorted(
        "load path items first ok map $0 value forEach show item sep queue async self reload pairs total i v "
        "ready done kind one use k finish x Box".split()
    )


def test_nested_functions_count_for_the_outer(listed):
    got = listed("func outer() {\n  func inner() { deep(q) }\n  inner()\n}\nfunc next() { other() }\n")
    assert got["outer(())"].calls_out == ["deep", "inner"]
    assert got["inner(())"].calls_out == ["deep"]
    assert got["next(())"].references == ["other"]


def test_accessors(listed):
    got = listed(
        "struct S {\n  var a: String { get { return store.value } set { store.value = newValue } }\n"
        "  var b = 1 { didSet { changed(b) } }\n  let c = { hidden() }\n  var d: Int { twice(e) }\n}\nprotocol P { var r: Int { get set } }\n"
    )
    assert got["a"].references == ["newValue", "store", "value"]
    assert got["b"].calls_out == ["changed"]
    assert got["c"].calls_out == [] and got["c"].references == []  # an initial value is no accessor
    assert got["d"].references == ["e", "twice"]
    assert got["r"].references == []


def test_strings_and_comments(listed):
    got = listed(
        'func f() {\n  // class Hidden { call() }\n  /* func no() { } */\n  log("} class X { \\(user.name(1)) {")\n'
        '  let t = """\n  func z() { }\n  """\n  let r = #"class Y { "q" }"#\n}\nstruct After {}\n'
    )
    assert list(got) == ["f(())", "t", "r", "After"]
    assert got["f(())"].references == ["log", "name", "user"]
    assert got["f(())"].calls_out == ["log", "name"]


def test_lists_blank_and_empty(spark):
    rows = [(1, "struct S {}"), (2, " \n\t"), (3, "import X\n"), (4, None), (5, "// only a comment")]
    found = S.symbols_or_null(spark.createDataFrame(rows, "file_id long, code string")).collect()
    got = {r.file_id: (r.symbols_json, r.reject) for r in found}
    assert json.loads(got[1][0]) == [{"symbolName": "S", "symbolKind": "struct"}]
    assert got[2] == got[4] == (None, "no_symbols")
    assert got[3] == got[5] == ("[]", None)


def test_long_source_does_not_overflow(spark):
    code = "func f() {\n" + "\n".join(f'  call{i}("{"a" * 20000}", x{i})' for i in range(50)) + "\n}\n/*" + "c" * 300000 + "*/"
    row = S.func_symbols(S.symbols(spark.createDataFrame([(1, code)], "file_id long, code string"))).first()
    assert len(row.calls_out) == 50 and len(row.references) == 100


def test_no_shuffle(spark):
    df = S.symbol_lists(spark.createDataFrame([(1, "struct S {}")], "file_id long, code string"))
    for rows in (df, S.symbols(spark.createDataFrame([(1, "struct S {}")], "file_id long, code string"))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan


def test_brackets_ten_deep(listed):
    deep = "(" * 10 + "x" + ")" * 10
    generic = "A<" * 9 + "Int, [B]" + ">" * 9
    squares = "[" * 10 + "y" + "]" * 10
    got = listed(
        f"@wrap({deep}, {{ class No {{}} }})\nclass C: {generic}, P {{\n  var v: {generic} = make({squares}), w = 2\n"
        f"  func f(a: {generic}, b: ({generic}) -> Void) -> {generic} {{ log(\"a \\(g({deep}, \"b \\(h(z))\"))\") }}\n}}\n"
    )
    assert list(got) == ["C", "v", "w", f"f((a: {generic}, b: ({generic}) -> Void) -> {generic})"]
    assert got["C"].conforms == [generic, "P"] and got["C"].attributes == ["@wrap"]
    assert got["v"].typeSignature == generic
    f = got[f"f((a: {generic}, b: ({generic}) -> Void) -> {generic})"]
    assert f.calls_out == ["g", "h", "log"] and f.references == ["g", "h", "log", "x", "z"]


def test_three_levels_of_comments(listed):
    got = listed("/* a /* func no() { /* } */ x */ \"b */ struct A {}\nfunc f() { /* { /* /* */ } */ // */ */\n */ g() }\nstruct B {}\n")
    assert list(got) == ["A", "f(())", "B"]
    assert got["f(())"].calls_out == ["g"]
    assert list(listed("struct A {} /* open { struct B {}")) == ["A"]


def test_regex_literals(listed):
    got = listed("func f() {\n  let r = /ab{2}c\\/[/}]/\n  match(/x(y)z/, #/a/{b}/#)\n  return a / b / c(d) / 2\n}\nstruct After {}\n")
    assert list(got) == ["f(())", "r", "After"]
    assert got["f(())"].calls_out == ["c", "match"] and got["f(())"].references == ["a", "b", "c", "d", "match"]


def test_generic_arguments_are_no_uses(listed):
    got = listed(
        "func f() {\n  Foo<Int, Bar>(x: 1)\n  let m = Map<Key, [Value: Set<Int>]>.make(one)\n  if a < b, c > d { e() }\n"
        "  g(h<i, j>k)\n  return x as? Box<Elem, Other> ?? nil\n}\nvar p = a < b, q = 2\n"
    )
    assert got["f(())"].references == sorted("Foo Map make one a b c d e g h i j k x".split())
    assert got["f(())"].calls_out == ["e", "g", "make"]
    assert "p" in got and "q" in got


def test_broken_sources_end(listed):
    assert list(listed("let s = \"text\nstruct A {}\n")) == ["s", "A"]
    assert list(listed("} } struct A { func f() { g(")) == ["A", "f(())"]
    assert list(listed("f(\"\\(\"\\(" * 20 + "\nstruct A {}")) == ["A"]
    assert list(listed("@a(\nstruct A {}")) == ["A"]
    assert listed("*/ ) ] > } \\ # \x01 \U0001f600 `") == {}


def owners_by_stack(code):
    """name -> called names of every function of a source made of ``func NAME() {``, ``NAME()`` and ``}``."""
    open_, out = [], {}
    for word in code.split():
        if word.endswith("{}"):
            continue
        if word == "}":
            open_.pop()
        elif word.startswith("f"):
            open_.append(word)
            out[word] = set()
        elif word.startswith("c"):
            for name in open_:
                out[name].add(word.removesuffix("()"))
    return {n: sorted(c) for n, c in out.items()}


@pytest.mark.parametrize("seed", range(4))
def test_bodies_of_random_nesting(spark, seed):
    import random

    rng, depth, parts, plain = random.Random(seed), 0, [], []
    for k in range(400):
        kind = rng.choice("ofc" if depth < 12 else "cc")
        if kind == "f":
            depth += 1
            parts.append(f"func f{k}() {{\n")
            plain.append(f"f{k}")
        elif kind == "o" and depth:
            depth -= 1
            parts.append("}\n")
            plain.append("}")
        else:
            n = rng.randint(0, 30)
            parts.append(f"c{n}()\n")
            plain.append(f"c{n}()")
    rows = S.symbols(spark.createDataFrame([(1, "".join(parts) + "}\n" * depth)], "file_id long, code string")).collect()
    assert {r.symbolName.removesuffix("(())"): r.calls_out for r in rows} == owners_by_stack(" ".join(plain))


def test_rows_of_any_key_type(spark):
    rows = S.symbol_lists(spark.createDataFrame([("a", "struct S {}"), (None, "let x = 1"), ("a", None)], "file string, src string"), "file", "src").collect()
    assert sorted((r.file or "", r.symbols_json or "") for r in rows) == [
        ("", '[{"symbolName":"x","symbolKind":"variable"}]'), ("a", ""), ("a", '[{"symbolName":"S","symbolKind":"struct"}]'),
    ]


PIECES = [*'"#@/`\\()[]{}<>=+-*?.,: \n_é日\x1c', "//", "/*", "*/", "\\(", "private(set)", "private ( set )", "unowned(safe)", "..<", "->", "1.5", "@a(", "#if", "=/", "++/", "foo", "`q`", "// c\n", "x<"]


@pytest.mark.parametrize("seed", range(3))
def test_plain_stretches_are_read_as_piece_by_piece(monkeypatch, seed):
    import random

    from tessella.functions import lexer

    rng = random.Random(seed)
    codes = ["".join(rng.choices(PIECES, k=rng.randint(1, 40))) for _ in range(1500)]
    at_once = [lexer.lex(c) for c in codes]
    monkeypatch.setattr(lexer, "_plain", lambda code, at, gap, out: (at, gap))
    assert at_once == [lexer.lex(c) for c in codes]


def test_no_token_leaves_the_task_unasked(spark):
    sources = spark.createDataFrame([(1, "struct S {\n func f() { g() }\n}"), (2, " "), (3, "")], "file_id long, code string")
    for rows in (S.symbols(sources), S.symbol_lists(sources), S.declarations(sources)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "tokens" not in plan and "stmts" not in plan and plan.count("MapInArrow") == 1 and "Union" not in plan
    assert S.tokens(sources, fields=("tok", "depth")).columns == ["file_id", "tok", "depth"]
    assert [r.tok for r in S.tokens(sources, fields=("tok",)).collect()] == "struct S { func f ( ) { g ( ) } }".split()


def described_rows(codes):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(len(codes)), pa.int64()), pa.array(codes, pa.string())], ["key", "code"])
    return [row["decls"] for rows in S._declared_rows(iter([batch])) for row in rows.to_pylist()]


CODE = [*"{}{}()[]<>.,:;=?!&\n\n\n", "class ", "struct ", "func ", "var ", "let ", "private(set) ", "@a(x) ", "in ", " where ", "case ", " as ", "init", "foo", "bar(", "T<A, B>", '"s"', '"\\(f { let q = g(1) })"', "// c {\n", "/* { */", "/r{1}/", "0..<n", "1.5", " -> ", " "]


@pytest.mark.parametrize("seed", range(3))
def test_sources_read_together_do_not_meet(seed):
    import random

    rng = random.Random(seed)
    codes = [None if rng.random() < 0.05 else "".join(rng.choices(CODE, k=rng.randint(0, 40))) for _ in range(300)]
    alone = [described_rows([c])[0] for c in codes]
    assert described_rows(codes) == alone
    assert sum(len(d or []) for d in alone) > 100


def test_steps_do_not_grow_with_the_tokens():
    """All tokens of a pack are found and judged together: few Python calls for each."""
    import sys

    body = "  let a = b.c(d, e[f]) + g\n  if a > h, k < m { n(o, p) } else { q = r(s) }\n"
    codes = [f"class T{i}: P<Int, [K]>, Q {{\n func f{i}(x: Int) -> Bool {{\n{body * 20} }}\n}}\n" for i in range(100)]
    calls = 0

    def count(_frame, event, _arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    described_rows(codes)
    before = sys.getprofile()
    sys.setprofile(count)
    try:
        found = described_rows(codes)
    finally:
        sys.setprofile(before)
    assert [len(d) for d in found] == [22] * 100
    assert calls < 0.5 * 100 * 20 * 38  # 38 tokens a body
