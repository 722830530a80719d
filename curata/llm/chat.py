"""Chat formatting: a compiler for a small sandboxed template language.

A template is cut into tokens and parsed into a syntax tree, constants are folded, and each node becomes a Python closure.
Nothing of Python is reachable from a template: values are strings, numbers, booleans, none, lists and mappings;
attributes are mapping keys; filters, tests, methods and functions come from fixed tables.

    {{ expression }}      literals, names, a.b, a['b'], a[1:], lists, + - * / // % ~, == != < > <= >= in, not in, and or
                          not, x if c else y, is [not] defined|none|string|mapping|..., value | filter(arguments),
                          methods of strings and mappings, namespace(), range(), raise_exception()
    {% for x in list if c %} ... {% else %} ... {% endfor %}    with loop.index, index0, first, last, length, previtem,
                          nextitem; also {% for k, v in mapping.items() %}; what a loop's body sets ends with the round
    {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}      {% set name = e %}, {% set space.name = e %}
    {% generation %} ... {% endgeneration %}    marks what a model is trained to produce
    {# comment #}         - inside a mark ({{- -}}, {%- -%}, {#- -#}) takes the white space beside it away

Strict templates raise TemplateError where something is looked up that isn't there; others take it for empty.

Rows of a conversation are taken by turn (null first), then role, then text; repeated rows are turns of their own.
A null text or role is empty. A row without conv_id is a conversation of its own. An empty table gives no rows; further
columns are not read. A conversation becomes one text, so the largest one has to fit into a task's memory; a task holds
one at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curata.llm.common import quoted, small_batches

START, END = "<|im_start|>", "<|im_end|>"

#: Turns between control strings; assistant texts are what is generated.
CHAT_TEMPLATE = (
    "{% for m in messages %}" + START + "{{ m.role | header }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.content | guard }}{% endgeneration %}"
    "{% else %}{{ m.content | guard }}{% endif %}" + END + "\n{% endfor %}"
)


class TemplateError(ValueError):
    """A template that can't be parsed, or that asks for something the sandbox or the data don't have."""


# ---------------------------------------------------------------- escapes


def guard(text: str) -> str:
    """No control string remains: one backslash more goes between < and |. `unguard` takes it out again."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unguard(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def header(role: str) -> str:
    """A role on one line, guarded."""
    return guard(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unheader(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unguard(line))


# ---------------------------------------------------------------- what templates can call


class _Missing:
    """What a lookup that finds nothing gives."""

    def __init__(self, what: str = "") -> None:
        self.what = what

    def __bool__(self) -> bool:
        return False

    def __iter__(self):
        return iter(())

    def __len__(self) -> int:
        return 0

    def __eq__(self, other) -> bool:
        return other is None or isinstance(other, _Missing)

    __hash__ = None


class Namespace(dict):
    """A mapping that {% set space.name = ... %} can write to, also from within a loop."""


#: Rounds of range() at most.
LONGEST_RANGE = 100_000


def _range(*args: int) -> list[int]:
    if len(range(*args)) > LONGEST_RANGE:
        raise TemplateError("range is too long")
    return list(range(*args))


def _raise(message: Any = "") -> None:
    raise TemplateError(str(message))


def _text(value: Any) -> str:
    return "" if value is None or isinstance(value, _Missing) else str(value)


def _is_number(v: Any) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


FILTERS: dict[str, Callable] = {
    "guard": lambda v: guard(_text(v)), "header": lambda v: header(_text(v)), "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(), "capitalize": lambda v: _text(v).capitalize(),
    "length": len, "count": len, "first": lambda v: next(iter(v), _Missing("first")), "last": lambda v: v[-1] if len(v) else _Missing("last"),
    "join": lambda v, by="": _text(by).join(map(_text, v)), "replace": lambda v, a, b: _text(v).replace(a, b),
    "default": lambda v, other="", boolean=False: other if isinstance(v, _Missing) or (boolean and not v) else v,
    "tojson": lambda v, indent=None: json.dumps(v, ensure_ascii=False, indent=indent), "string": _text, "int": lambda v: int(v),
    "list": lambda v: list(v), "items": lambda v: [list(x) for x in v.items()], "reverse": lambda v: v[::-1],
}
TESTS: dict[str, Callable[[Any], bool]] = {
    "defined": lambda v: not isinstance(v, _Missing), "undefined": lambda v: isinstance(v, _Missing), "none": lambda v: v is None,
    "string": lambda v: isinstance(v, str), "number": _is_number, "boolean": lambda v: isinstance(v, bool), "mapping": lambda v: isinstance(v, dict),
    "iterable": lambda v: isinstance(v, (str, list, dict)), "sequence": lambda v: isinstance(v, (str, list)), "true": lambda v: v is True, "false": lambda v: v is False,
    "odd": lambda v: v % 2 == 1, "even": lambda v: v % 2 == 0,
}
METHODS: dict[type, dict[str, Callable]] = {
    str: {
        "strip": str.strip, "lstrip": str.lstrip, "rstrip": str.rstrip, "upper": str.upper, "lower": str.lower, "title": str.title, "split": str.split,
        "startswith": lambda s, x: s.startswith(x), "endswith": lambda s, x: s.endswith(x), "replace": lambda s, a, b: s.replace(a, b),
    },
    dict: {"get": dict.get, "items": lambda d: [list(x) for x in d.items()], "keys": lambda d: list(d), "values": lambda d: list(d.values())},
}
FUNCTIONS: dict[str, Callable] = {"raise_exception": _raise, "range": _range, "namespace": lambda **values: Namespace(values)}


def _add(a: Any, b: Any) -> Any:
    if _is_number(a) and _is_number(b) or isinstance(a, list) and isinstance(b, list):
        return a + b
    return f"{_text(a)}{_text(b)}"


def _arithmetic(f: Callable) -> Callable:
    def run(a: Any, b: Any) -> Any:
        if not (_is_number(a) and _is_number(b)):
            raise TemplateError("arithmetic is for numbers")
        return f(a, b)

    return run


_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: not a == b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b, "not in": lambda a, b: a not in b, "+": _add, "~": lambda a, b: f"{_text(a)}{_text(b)}",
    "-": _arithmetic(lambda a, b: a - b), "*": _arithmetic(lambda a, b: a * b), "/": _arithmetic(lambda a, b: a / b), "//": _arithmetic(lambda a, b: a // b), "%": _arithmetic(lambda a, b: a % b),
}

# ---------------------------------------------------------------- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Get:
    of: Any
    key: Any


@dataclass(frozen=True)
class Slice:
    of: Any
    bounds: tuple  # start, stop, step; None where left out


@dataclass(frozen=True)
class Listing:
    items: tuple


@dataclass(frozen=True)
class Filter:
    of: Any
    name: str
    args: tuple = ()
    named: tuple = ()


@dataclass(frozen=True)
class Test:
    of: Any
    name: str


@dataclass(frozen=True)
class Call:
    of: Any  # None: a function
    name: str
    args: tuple
    named: tuple


@dataclass(frozen=True)
class Choice:
    condition: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Op:
    op: str
    args: tuple


@dataclass(frozen=True)
class Out:
    expr: Any


@dataclass(frozen=True)
class Put:
    target: tuple  # a name, or a namespace's name and a key
    expr: Any


@dataclass(frozen=True)
class For:
    names: tuple
    over: Any
    condition: Any
    body: tuple
    empty: tuple


@dataclass(frozen=True)
class If:
    arms: tuple  # of (condition, body)


@dataclass(frozen=True)
class Generation:
    body: tuple


# ---------------------------------------------------------------- tokens

_TOKEN = re.compile(
    r"(?P<space>\s+)|(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<num>\d+(?:\.\d+)?)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|//|[-+*/%~<>()\[\].|,:=])", re.S
)
_OPEN = re.compile(r"\{\{|\{%|\{#")


def tokens(source: str, trim_blocks: bool = False, lstrip_blocks: bool = False) -> list[tuple[str, Any]]:
    """("text", str), ("out", tokens) and ("do", tokens) in order, with white space taken away as the marks say."""
    out: list[tuple[str, Any]] = []
    at, strip = 0, False

    def text(piece: str) -> None:
        piece = piece.lstrip() if strip else piece
        if piece:
            out.append(("text", piece))

    while True:
        m = _OPEN.search(source, at)
        if not m:
            text(source[at:])
            return out
        kind, inside = m[0], m.end()
        before = source[at : m.start()]
        if source.startswith("-", inside):
            before, inside = before.rstrip(), inside + 1
        elif lstrip_blocks and kind != "{{":
            line = source.rfind("\n", 0, m.start()) + 1
            before = before if source[line : m.start()].strip(" \t") else before.rstrip(" \t")
        text(before)
        if kind == "{#":
            end = source.find("#}", inside)
            if end < 0:
                raise TemplateError("a comment doesn't end")
            strip = source[end - 1] == "-" and end > inside
            at = end + 2
        else:
            close, found = "}}" if kind == "{{" else "%}", []
            while True:
                strip = source.startswith("-" + close, inside)
                if strip or source.startswith(close, inside):
                    break
                t = _TOKEN.match(source, inside)
                if not t:
                    raise TemplateError(f"can't read {source[inside : inside + 20]!r}")
                if t.lastgroup != "space":
                    found.append((t.lastgroup, t[0]))
                inside = t.end()
            out.append(("out" if kind == "{{" else "do", found))
            at = inside + len(close) + strip
        if trim_blocks and kind != "{{" and not strip and source.startswith("\n", at):
            at += 1


_CONSTANTS = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class _Reader:
    """Recursive descent over the tokens of one mark."""

    def __init__(self, found: list[tuple[str, str]]) -> None:
        self.tokens, self.at = found, 0

    def kind(self, ahead: int = 0) -> tuple[str | None, str | None]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else (None, None)

    def take(self, *values: str) -> str | None:
        kind, value = self.kind()
        if kind in ("op", "name") and value in values:
            self.at += 1
            return value
        return None

    def must(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value} is missing")

    def end(self) -> None:
        if self.at != len(self.tokens):
            raise TemplateError(f"not expected: {self.tokens[self.at][1]!r}")

    def identifier(self) -> str:
        kind, value = self.kind()
        if kind != "name" or value.startswith("_"):
            raise TemplateError(f"not a name: {value!r}")
        self.at += 1
        return value

    def expression(self, choice: bool = True):
        out = self.either()
        while choice and self.take("if"):
            condition = self.either()
            out = Choice(condition, out, self.expression() if self.take("else") else Const(""))
        return out

    def either(self):
        out = self.both()
        while self.take("or"):
            out = Op("or", (out, self.both()))
        return out

    def both(self):
        out = self.negated()
        while self.take("and"):
            out = Op("and", (out, self.negated()))
        return out

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        out = self.joined()
        while True:
            if self.kind()[1] == "not" and self.kind(1)[1] == "in":
                self.at += 2
                out = Op("not in", (out, self.joined()))
            elif op := self.take("==", "!=", "<", ">", "<=", ">=", "in"):
                out = Op(op, (out, self.joined()))
            else:
                return out

    def _left(self, below: Callable, *ops: str):
        out = below()
        while op := self.take(*ops):
            out = Op(op, (out, below()))
        return out

    def joined(self):
        return self._left(self.added, "~")

    def added(self):
        return self._left(self.multiplied, "+", "-")

    def multiplied(self):
        return self._left(self.signed, "*", "/", "//", "%")

    def signed(self):
        return Op("-", (Const(0), self.signed())) if self.take("-") else self.filtered()

    def filtered(self):
        out = self.reached()
        while True:
            if self.take("|"):
                name = self.identifier()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                out = Filter(out, name, *(self.arguments() if self.take("(") else ((), ())))
            elif self.take("is"):
                negative = bool(self.take("not"))
                name = self.identifier()
                if name not in TESTS:
                    raise TemplateError(f"no test {name!r}")
                out = Op("not", (Test(out, name),)) if negative else Test(out, name)
            else:
                return out

    def arguments(self) -> tuple[tuple, tuple]:
        """Positional and named arguments, after the opening bracket."""
        plain, named = [], []
        while not self.take(")"):
            if plain or named:
                self.must(",")
            if self.kind()[0] == "name" and self.kind(1)[1] == "=":
                name = self.identifier()
                self.at += 1
                named.append((name, self.expression()))
            else:
                plain.append(self.expression())
        return tuple(plain), tuple(named)

    def reached(self):
        out = self.single()
        while op := self.take(".", "["):
            if op == ".":
                name = self.identifier()
                if self.take("("):
                    if not any(name in table for table in METHODS.values()):
                        raise TemplateError(f"no method {name!r}")
                    out = Call(out, name, *self.arguments())
                else:
                    out = Get(out, Const(name))
                continue
            bounds: list = [None]
            while not self.take("]"):
                if self.take(":"):
                    bounds.append(None)
                elif bounds[-1] is None and self.kind()[0]:
                    bounds[-1] = self.expression()
                else:
                    raise TemplateError("] is missing")
            if len(bounds) > 3 or bounds == [None]:
                raise TemplateError("can't read what is in [ ]")
            out = Get(out, bounds[0]) if len(bounds) == 1 else Slice(out, (*bounds, None)[:3])
        return out

    def single(self):
        if self.take("("):
            out = self.expression()
            self.must(")")
            return out
        if self.take("["):
            items: list = []
            while not self.take("]"):
                if items:
                    self.must(",")
                items.append(self.expression())
            return Listing(tuple(items))
        kind, value = self.kind()
        if kind is None:
            raise TemplateError("an expression ends early")
        if kind == "op":
            raise TemplateError(f"not expected: {value!r}")
        if kind == "name":
            name = self.identifier()
            if name in _CONSTANTS:
                return Const(_CONSTANTS[name])
            if self.take("("):
                if name not in FUNCTIONS:
                    raise TemplateError(f"no function {name!r}")
                return Call(None, name, *self.arguments())
            return Name(name)
        self.at += 1
        if kind == "num":
            return Const(float(value) if "." in value else int(value))
        return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))


def parse(source: str, trim_blocks: bool = False, lstrip_blocks: bool = False) -> tuple:
    """The syntax tree of a template."""
    parts, at = tokens(source, trim_blocks, lstrip_blocks), 0

    def whole(reader: _Reader):
        out = reader.expression()
        reader.end()
        return out

    def block(ends: tuple[str, ...]) -> tuple[tuple, str, _Reader | None]:
        """What stands before one of the ends, that end, and the rest of its mark."""
        nonlocal at
        out: list = []
        while at < len(parts):
            kind, part = parts[at]
            at += 1
            if kind == "text":
                out.append(Out(Const(part)))
                continue
            reader = _Reader(part)
            if kind == "out":
                out.append(Out(whole(reader)))
                continue
            word = reader.identifier()
            if word in ends:
                if word != "elif":
                    reader.end()
                return tuple(out), word, reader
            if word == "for":
                names = [reader.identifier()]
                while reader.take(","):
                    names.append(reader.identifier())
                reader.must("in")
                over = reader.expression(choice=False)
                condition = reader.expression() if reader.take("if") else None
                reader.end()
                body, end, _ = block(("endfor", "else"))
                empty = block(("endfor",))[0] if end == "else" else ()
                out.append(For(tuple(names), over, condition, body, empty))
            elif word == "if":
                arms, condition = [], whole(reader)
                while True:
                    body, end, rest = block(("elif", "else", "endif") if not arms or arms[-1][0] is not _ELSE else ("endif",))
                    arms.append((condition, body))
                    if end == "endif":
                        break
                    condition = _ELSE if end == "else" else whole(rest)
                out.append(If(tuple((Const(True) if c is _ELSE else c, b) for c, b in arms)))
            elif word == "set":
                target = [reader.identifier()]
                if reader.take("."):
                    target.append(reader.identifier())
                reader.must("=")
                out.append(Put(tuple(target), whole(reader)))
            elif word == "generation":
                reader.end()
                out.append(Generation(block(("endgeneration",))[0]))
            else:
                raise TemplateError(f"no statement {word!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(out), "", None

    return block(())[0]


_ELSE = object()


def _known(node, *parts) -> Any:
    """The node's value as a constant, if all parts are; what can't be worked out is left to fail where it is rendered."""
    if all(isinstance(p, Const) for p in parts):
        try:
            value = _evaluator(node, True)({})
        except Exception:  # noqa: BLE001  a template may guard it by a condition
            return node
        if value is None or isinstance(value, (str, int, float, bool)):
            return Const(value)
    return node


def fold(node):
    """The same tree with what is constant worked out, dead arms gone and neighbouring texts joined."""
    match node:
        case tuple():
            out: list = []
            for x in map(fold, node):
                for y in x if isinstance(x, tuple) else (x,):
                    if isinstance(y, Out) and isinstance(y.expr, Const) and out and isinstance(out[-1], Out) and isinstance(out[-1].expr, Const):
                        out[-1] = Out(Const(_text(out[-1].expr.value) + _text(y.expr.value)))
                    else:
                        out.append(y)
            return tuple(out)
        case Op(op, args):
            args = tuple(map(fold, args))
            return _known(Op(op, args), *args)
        case Filter(of, name, args, named):
            of, args, named = fold(of), tuple(map(fold, args)), tuple((k, fold(v)) for k, v in named)
            return _known(Filter(of, name, args, named), of, *args, *(v for _, v in named))
        case Test(of, name):
            of = fold(of)
            return _known(Test(of, name), of)
        case Choice(condition, yes, no):
            condition = fold(condition)
            if isinstance(condition, Const):
                return fold(yes if condition.value else no)
            return Choice(condition, fold(yes), fold(no))
        case Get(of, key):
            return Get(fold(of), fold(key))
        case Slice(of, bounds):
            return Slice(fold(of), tuple(b and fold(b) for b in bounds))
        case Listing(items):
            return Listing(tuple(map(fold, items)))
        case Call(of, name, args, named):
            return Call(fold(of), name, tuple(map(fold, args)), tuple((k, fold(v)) for k, v in named))
        case Out(expr):
            return Out(fold(expr))
        case Put(target, expr):
            return Put(target, fold(expr))
        case For(names, over, condition, body, empty):
            return For(names, fold(over), fold(condition), fold(body), fold(empty))
        case Generation(body):
            return Generation(fold(body))
        case If(arms):
            kept: list = []
            for condition, body in arms:
                condition = fold(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                kept.append((condition, fold(body)))
                if isinstance(condition, Const):
                    break
            if not kept:
                return ()
            return kept[0][1] if isinstance(kept[0][0], Const) else If(tuple(kept))
    return node


# ---------------------------------------------------------------- closures


def _look(holder: Any, key: Any) -> Any:
    if isinstance(holder, dict) and isinstance(key, (str, int, float, bool)):
        return holder.get(key, _Missing(str(key)))
    if isinstance(holder, (list, str)) and isinstance(key, int) and -len(holder) <= key < len(holder):
        return holder[key]
    return _Missing(str(key))


def _lookup(node, strict: bool) -> Callable[[dict], Any]:
    """A closure for a node whose value may be missing, which the caller deals with."""
    match node:
        case Name(name):
            absent = _Missing(name)
            return lambda env: env.get(name, absent)
        case Get(of, key):
            holder, at = _evaluator(of, strict), _evaluator(key, strict)
            return lambda env: _look(holder(env), at(env))
    return _evaluator(node, strict)


def _evaluator(node, strict: bool) -> Callable[[dict], Any]:
    compiled = lambda x: _evaluator(x, strict)
    match node:
        case Const(value):
            return lambda env: value
        case Name() | Get():
            find = _lookup(node, strict)
            if not strict:
                return find

            def found(env):
                value = find(env)
                if isinstance(value, _Missing):
                    raise TemplateError(f"{value.what!r} is not defined")
                return value

            return found
        case Slice(of, bounds):
            holder, edges = compiled(of), [compiled(b) if b else lambda env: None for b in bounds]

            def part(env):
                value = holder(env)
                return value[slice(*(e(env) for e in edges))] if isinstance(value, (list, str)) else _Missing("slice")

            return part
        case Listing(items):
            parts = [compiled(x) for x in items]
            return lambda env: [p(env) for p in parts]
        case Filter(of, name, args, named):
            # a default is for what is missing
            value, f = _lookup(of, strict) if name == "default" else compiled(of), FILTERS[name]
            plain, by_name = [compiled(a) for a in args], [(k, compiled(v)) for k, v in named]
            if not plain and not by_name:
                return lambda env: f(value(env))
            return lambda env: f(value(env), *(a(env) for a in plain), **{k: v(env) for k, v in by_name})
        case Test(of, name):
            value, test = _lookup(of, strict) if name in ("defined", "undefined") else compiled(of), TESTS[name]
            return lambda env: test(value(env))
        case Call(of, name, args, named):
            plain, by_name = [compiled(a) for a in args], [(k, compiled(v)) for k, v in named]
            if of is None:
                call = FUNCTIONS[name]
                return lambda env: call(*(a(env) for a in plain), **{k: v(env) for k, v in by_name})
            holder = compiled(of)

            def method(env):
                value = holder(env)
                for kind, table in METHODS.items():
                    if isinstance(value, kind) and name in table:
                        return table[name](value, *(a(env) for a in plain), **{k: v(env) for k, v in by_name})
                raise TemplateError(f"{type(value).__name__} has no method {name!r}")

            return method
        case Choice(condition, yes, no):
            condition, yes, no = compiled(condition), compiled(yes), compiled(no)
            return lambda env: yes(env) if condition(env) else no(env)
        case Op("not", (a,)):
            a = compiled(a)
            return lambda env: not a(env)
        case Op("and", (a, b)):
            a, b = compiled(a), compiled(b)
            return lambda env: a(env) and b(env)
        case Op("or", (a, b)):
            a, b = compiled(a), compiled(b)
            return lambda env: a(env) or b(env)
        case Op(op, (a, b)):
            a, b, f = compiled(a), compiled(b), _BINARY[op]
            return lambda env: f(a(env), b(env))
    raise TemplateError(f"not an expression: {node!r}")


def _renderer(body: tuple, strict: bool) -> Callable[[dict, Callable[[str, bool], None], bool], None]:
    """A closure that calls put(text, generated) for each piece of output."""
    steps = [_step(x, strict) for x in body]

    def run(env, put, inside):
        for step in steps:
            step(env, put, inside)

    return steps[0] if len(steps) == 1 else run


def _step(node, strict: bool):
    match node:
        case Out(Const(value)):
            text = _text(value)
            return lambda env, put, inside: put(text, inside)
        case Out(expr):
            value = _evaluator(expr, strict)
            return lambda env, put, inside: put(_text(value(env)), inside)
        case Put((name,), expr):
            value = _evaluator(expr, strict)

            def assign(env, put, inside):
                env[name] = value(env)

            return assign
        case Put((space, key), expr):
            value = _evaluator(expr, strict)

            def write(env, put, inside):
                holder = env.get(space)
                if not isinstance(holder, Namespace):
                    raise TemplateError(f"{space!r} is no namespace")
                holder[key] = value(env)

            return write
        case Generation(body):
            inner = _renderer(body, strict)
            return lambda env, put, inside: inner(env, put, True)
        case If(arms):
            arms = [(_evaluator(c, strict), _renderer(b, strict)) for c, b in arms]

            def branch(env, put, inside):
                for condition, body in arms:
                    if condition(env):
                        body(env, put, inside)
                        return

            return branch
        case For(names, over, condition, body, empty):
            over, inner, otherwise = _evaluator(over, strict), _renderer(body, strict), _renderer(empty, strict)
            wanted = _evaluator(condition, strict) if condition is not None else None

            def bound(env, item):
                if len(names) == 1:
                    return {**env, names[0]: item}
                if not isinstance(item, list) or len(item) != len(names):
                    raise TemplateError(f"can't deal an item to {', '.join(names)}")
                return {**env, **dict(zip(names, item, strict=True))}

            def loop(env, put, inside):
                values = over(env)
                if not isinstance(values, (list, str, dict, _Missing)):
                    raise TemplateError(f"{type(values).__name__} is no list")
                items = [x for x in values if wanted is None or wanted(bound(env, x))]
                if not items:
                    otherwise(env, put, inside)
                n = len(items)
                for i, item in enumerate(items):
                    own = bound(env, item)
                    own["loop"] = {"index0": i, "index": i + 1, "first": i == 0, "last": i + 1 == n, "length": n, **({"previtem": items[i - 1]} if i else {}), **({"nextitem": items[i + 1]} if i + 1 < n else {})}
                    inner(own, put, inside)

            return loop
    raise TemplateError(f"not a statement: {node!r}")


class Template:
    """A compiled template."""

    def __init__(self, source: str, strict: bool = False, trim_blocks: bool = False, lstrip_blocks: bool = False) -> None:
        self.tree = fold(parse(source, trim_blocks, lstrip_blocks))
        self.run = _renderer(self.tree, strict)

    def render(self, messages: list[dict], **more) -> tuple[str, list[tuple[int, int]]]:
        """The text, and the spans of code points in it that are generated (neighbours joined)."""
        out: list[str] = []
        spans: list[list[int]] = []
        at = 0

        def put(text: str, generated: bool) -> None:
            nonlocal at
            if text:
                out.append(text)
                if generated:
                    if spans and spans[-1][1] == at:
                        spans[-1][1] = at + len(text)
                    else:
                        spans.append([at, at + len(text)])
                at += len(text)

        try:
            self.run({"messages": list(messages), **more}, put, False)
        except (TypeError, AttributeError, ValueError, ZeroDivisionError, IndexError, KeyError) as e:
            raise e if isinstance(e, TemplateError) else TemplateError(str(e)) from e
        return "".join(out), [(a, b) for a, b in spans]


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of what CHAT_TEMPLATE rendered."""
    out = []
    for turn in formatted.split(START)[1:]:
        role, _, text = turn.partition("\n")
        out.append((unheader(role), unguard(text[: text.index(END)])))
    return out


def format_conversations(rows: DataFrame, template: str = CHAT_TEMPLATE, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", strict: bool = True) -> DataFrame:
    """conv_id, formatted (string), generated (array of struct start, end in code points): one row a conversation.

    Rows are dealt by conversation and sorted within a partition; a task holds one conversation at a time.
    """
    small_batches(rows.sparkSession)
    Template(template, strict)  # fail here rather than in a task
    empty = lambda c: F.coalesce(F.col(quoted(c)), F.lit(""))
    named = rows.select(F.col(quoted(conv)).cast("bigint").alias("conv_id"), F.col(quoted(turn)).cast("bigint").alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text")).otherwise(F.col("conv_id"))
    ordered = named.repartition(alone).sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, strict)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        each = (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True))
        ids, texts, spans, held, lone = [], [], [], 0, 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, kind)], names=["conv_id", "formatted", "generated"])

        def conversation(x):
            nonlocal lone
            lone += x[0] is None
            return x[0], lone if x[0] is None else 0

        for (key, _), group in groupby(each, key=conversation):
            formatted, generated = compiled.render([{"role": r, "content": t} for _, r, t in group])
            ids.append(key)
            texts.append(formatted)
            spans.append([{"start": a, "end": b} for a, b in generated])
            held += len(formatted)
            if held > 1 << 20:
                yield flush()
                ids, texts, spans, held = [], [], [], 0
        if ids:
            yield flush()

    return ordered.mapInArrow(run, "conv_id bigint, formatted string, generated array<struct<start:int,end:int>>")
