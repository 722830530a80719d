"""Templates: control of white space, comments, loops over the same messages, strict lookups, the sandbox."""

import pytest

from curata.llm import chat

TURNS = [{"role": "system", "content": "be brief"}, {"role": "user", "content": "hi"}, {"role": "assistant", "content": "hello"}]


def text(source, messages=TURNS, strict=True, **more):
    return chat.Template(source, strict, **{k: more.pop(k) for k in ("trim_blocks", "lstrip_blocks") if k in more}).render(messages, **more)[0]


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("{% if messages[0].role == 'system' %}{{ messages[0]['content'] }}{% endif %}", "be brief"),
        ("{% for m in messages %}{{ m.role[0] }}{% endfor %}/{% for m in messages[1:] %}{{ m.content }}{% endfor %}", "sua/hihello"),
        ("{{ messages | length }}{{ messages[-1].role }}", "3assistant"),
        ("a  {%- if true -%}  b  {%- endif -%}  c", "abc"),
        ("a {{- ' b ' -}} c", "a b c"),
        ("a{# no {{ output }} here #}b {#- x -#} c", "abc"),
        ("{{ '}}' }}{{ \"%}\" }}{{ '{{' }}", "}}%}{{"),
        ("{{ 'it\\'s' }}{{ \"a\\nb\" }}", "it'sa\nb"),
        ("{{ 1 + 2 * 3 }} {{ 7 // 2 }} {{ 7 % 4 }} {{ -2 + 5 }} {{ 'a' ~ 1 }}", "7 3 3 3 a1"),
        ("{{ 'x' if messages else 'y' }}{{ 'x' if not messages else 'y' }}", "xy"),
        ("{{ nothing is defined }} {{ messages is defined }} {{ nothing | default('d') }} {{ messages[0].tool | default('none') }}", "False True d none"),
        ("{{ 'b' not in 'abc' }} {{ 'b' in 'abc' }} {{ none is none }} {{ 'x' is string }}", "False True True True"),
        ("{% set ns = namespace(n=0) %}{% for m in messages %}{% set ns.n = ns.n + 1 %}{% endfor %}{{ ns.n }}", "3"),
        ("{% set x = 1 %}{% for m in messages %}{% set x = x + 1 %}{% endfor %}{{ x }}", "1"),
        ("{% for m in messages if m.role != 'system' %}{{ loop.index }}{{ loop.last }}{% else %}none{% endfor %}", "1False2True"),
        ("{% for m in [] %}x{% else %}none{% endfor %}", "none"),
        ("{% for k, v in messages[0].items() %}{{ k }}={{ v }};{% endfor %}", "role=system;content=be brief;"),
        ("{{ messages[1].content.strip().upper() }}{{ 'a,b'.split(',') | join('-') }}", "HIa-b"),
        ("{{ messages[0] | tojson }}", '{"role": "system", "content": "be brief"}'),
        ("{% for m in messages %}{% if not loop.first %}{{ loop.previtem.role }}>{% endif %}{% endfor %}", "system>user>"),
        ("{% for i in range(3) %}{{ i }}{% endfor %}", "012"),
    ],
)
def test_render(source, expected):
    assert text(source) == expected
    assert text(source, strict=False) == expected


def test_blocks_of_lines():
    source = "{% for m in messages %}\n    {% if m.role == 'user' %}\n{{ m.content }}\n    {% endif %}\n{% endfor %}\n"
    assert text(source, trim_blocks=True, lstrip_blocks=True) == "hi\n"


@pytest.mark.parametrize("source", ["{{ nothing }}", "{{ messages[0].tool }}", "{{ messages[9] }}", "{% for x in nothing %}{% endfor %}", "{{ nothing.x }}", "{% if nothing %}{% endif %}", "{{ nothing | upper }}"])
def test_strict_lookups(source):
    with pytest.raises(chat.TemplateError):
        text(source)
    assert text(source, strict=False) == ""


@pytest.mark.parametrize(
    "source",
    ["{{ 'a'.__class__ }}", "{{ 'a'.format(1) }}", "{{ open('x') }}", "{{ messages.append(1) }}", "{{ x | attr('y') }}", "{{ (1 }}", "{{ [1, 2 }}", "{{ a[ }}", "{% if x %}", "{% endif %}", "{{ 'open }}", "{% for in x %}{% endfor %}", "{{ a b }}", "{# open", "{{ 1 +", "{% else %}", "{{ range.x( }}"],
)
def test_what_cannot_be_parsed(source):
    with pytest.raises(chat.TemplateError):
        chat.Template(source)


@pytest.mark.parametrize("source", ["{{ raise_exception('no') }}", "{{ 'a' * 1000 }}", "{{ 1 / 0 }}", "{{ range(10000000) }}", "{% for m in 5 %}{% endfor %}", "{{ 'a' < 1 }}", "{% set messages.x = 1 %}"])
def test_what_fails_when_it_is_rendered(source):
    template = chat.Template("{% if messages %}" + source + "{% endif %}")
    assert template.render([]) == ("", [])
    with pytest.raises(chat.TemplateError):
        template.render(TURNS)


def test_folding_and_generation():
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 + 1 }}{% if 1 in [1] %}c{% endif %}{{ 'x' | upper }}{{ 'y' if true else z }}")) != ()
    assert chat.fold(chat.parse("a{{ 'b' ~ (1 + 1) }}{{ 'x' | upper }}{{ 'y' if true else z }}")) == (chat.Out(chat.Const("ab2Xy")),)
    found, spans = chat.Template("{% for m in messages %}{% if m.role == 'assistant' %}[{% generation %}{{ m.content }}{% if loop.last %}!{% endif %}{% endgeneration %}]{% endif %}{% endfor %}").render(TURNS * 2)
    assert found == "[hello][hello!]" and [found[a:b] for a, b in spans] == ["hello", "hello!"]


def test_rows_without_conversation(spark):
    rows = [(None, 0, "user", "x"), (None, 0, "user", "x"), (None, 1, "user", "y"), (4, 0, "user", "z"), (4, 1, "assistant", "w" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as formatted", "2 as `a.b`")
    got = sorted(((r["conv_id"] or 0, chat.read_back(r["formatted"])) for r in chat.format_conversations(df).collect()), key=str)
    assert got == [(0, [("user", "x")]), (0, [("user", "x")]), (0, [("user", "y")]), (4, [("user", "z"), ("assistant", "w" * 200_000)])]
    with pytest.raises(chat.TemplateError):
        chat.format_conversations(df, "{{ open( }}")
