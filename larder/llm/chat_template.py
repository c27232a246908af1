"""A small sandboxed template language for conversations, compiled to Python closures.

    {% control "<turn>", "</turn>" %}          control strings that ``escape`` guards
    {% set bos = "<s>" ~ model %}              names; inside the loop they live for one turn
    {% for m in messages %} ... {% endfor %}   the one pass over the turns, at the top level
    {% if m.role == "user" %} ... {% elif %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}   what is written in here is what a model learns
    {{ m.text | trim | escape }}               values, with filters; {# a comment #}

``{%-``, ``-%}``, ``{{-`` and ``-}}`` strip the white space on their side.  Expressions know strings, whole
numbers, true, false, none, names, ``.name`` and ``["name"]`` of a record, ``loop.index``, ``loop.index0``,
``loop.first``, ``loop.last``, ``+ - ~ == != < <= > >= in not and or``, ``a if c else b``, brackets and
filters.  Nothing else can be reached: there are no calls, no Python attributes, no loops but the
one over ``messages``, and names are bound when the template is compiled, so a template runs in
time and memory proportional to one turn and cannot touch its host.

Stages: ``tokens`` -> ``parse`` (syntax tree) -> ``fold`` (constants, dead branches, joined text) ->
``Template`` (closures for what stands before the loop, one turn, and what stands after it).  A
template that never asks for ``loop`` renders each turn without knowing its neighbours."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field


class TemplateError(ValueError):
    """The template is not of the language, or asks for something outside the sandbox."""


# ---------------------------------------------------------------------------------------
# words
# ---------------------------------------------------------------------------------------

_MARK = re.compile(r"\{([{%#])(-?)(.*?)(-?)([}%#])\}", re.S)
_WORD = re.compile(r"""\s*(?:(?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(?P<number>[0-9]+)|(?P<name>[A-Za-z_][A-Za-z0-9_]*)"""
                   r"""|(?P<sign>==|!=|<=|>=|[-+~<>|.,()\[\]=]))""", re.S)
_CLOSING = {"{": "}", "%": "%", "#": "#"}
_BACKSLASHED = {"n": "\n", "t": "\t", "r": "\r"}


def _words(code: str) -> list[tuple[str, str]]:
    out, at = [], 0
    while code[at:].strip():
        m = _WORD.match(code, at)
        if not m:
            raise TemplateError(f"unreadable: {code[at:].strip()[:20]!r}")
        kind, word = m.lastgroup, m[m.lastgroup]
        if kind == "text":
            word = re.sub(r"\\(.)", lambda x: _BACKSLASHED.get(x[1], x[1]), word[1:-1], flags=re.S)
        out.append((kind, word))
        at = m.end()
    return out


def tokens(source: str) -> list[tuple[str, object]]:
    """("text", str), ("value", words) and ("tag", words) in order; comments are gone."""
    out: list[tuple[str, object]] = []
    at, strip = 0, False
    while at <= len(source):
        start = source.find("{", at)
        while start >= 0 and source[start + 1:start + 2] not in ("{", "%", "#"):
            start = source.find("{", start + 1)
        text = source[at:] if start < 0 else source[at:start]
        m = _MARK.match(source, start) if start >= 0 else None
        if start >= 0 and (not m or _CLOSING[m[1]] != m[5]):
            raise TemplateError(f"unclosed: {source[start:start + 20]!r}")
        text = text.lstrip() if strip else text
        text = text.rstrip() if m and m[2] else text
        if text:
            out.append(("text", text))
        if not m:
            return out
        if m[1] != "#":
            out.append(("value" if m[1] == "{" else "tag", _words(m[3])))
        at, strip = m.end(), bool(m[4])
    return out


# ---------------------------------------------------------------------------------------
# syntax tree
# ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    name: str


@dataclass(frozen=True)
class Binary:
    sign: str
    left: object
    right: object


@dataclass(frozen=True)
class Not:
    value: object


@dataclass(frozen=True)
class Choice:
    test: object
    yes: object
    no: object


@dataclass(frozen=True)
class Filter:
    name: str
    value: object
    arguments: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Write:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    test: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    body: tuple


#: What ``loop`` tells; a template that uses any of it needs the turn's position.
POSITIONS = ("index", "index0", "first", "last")


def _shown(value) -> str:
    return "" if value is None else str(value) if not isinstance(value, bool) else str(value).lower()


#: Filters that need nothing but their value, by name: (least, most arguments, function).
FILTERS: dict[str, tuple[int, int, Callable]] = {
    "trim": (0, 0, lambda v: _shown(v).strip()),
    "upper": (0, 0, lambda v: _shown(v).upper()),
    "lower": (0, 0, lambda v: _shown(v).lower()),
    "length": (0, 0, lambda v: len(_shown(v))),
    "string": (0, 0, _shown),
    "default": (1, 1, lambda v, other: other if v is None or v == "" else v),
    "replace": (2, 2, lambda v, a, b: _shown(v).replace(a, b) if a else _shown(v)),
}


class _Parser:
    """Recursive descent over the words of one tag or value."""

    def __init__(self, words: list[tuple[str, str]]):
        self.words, self.at = words, 0

    def peek(self, *wanted: str) -> bool:
        kind, word = self.words[self.at] if self.at < len(self.words) else ("end", "")
        return kind in ("sign", "name") and word in wanted

    def take(self, *wanted: str) -> bool:
        found = self.peek(*wanted)
        self.at += found
        return found

    def need(self, *wanted: str) -> None:
        if not self.take(*wanted):
            raise TemplateError(f"expected {' or '.join(wanted)}")

    def name(self) -> str:
        if self.at >= len(self.words) or self.words[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        return self.words[self.at - 1][1]

    def end(self) -> None:
        if self.at < len(self.words):
            raise TemplateError(f"unexpected {self.words[self.at][1]!r}")

    def value(self):
        yes = self.either()
        if not self.take("if"):
            return yes
        test = self.either()
        self.need("else")
        return Choice(test, yes, self.value())

    def either(self):
        out = self.both()
        while self.take("or"):
            out = Binary("or", out, self.both())
        return out

    def both(self):
        out = self.negated()
        while self.take("and"):
            out = Binary("and", out, self.negated())
        return out

    def negated(self):
        return Not(self.negated()) if self.take("not") else self.compared()

    def compared(self):
        out = self.joined()
        while True:
            for sign in ("==", "!=", "<=", ">=", "<", ">", "in"):
                if self.take(sign):
                    out = Binary(sign, out, self.joined())
                    break
            else:
                if self.peek("not"):
                    self.at += 1
                    self.need("in")
                    out = Not(Binary("in", out, self.joined()))
                else:
                    return out

    def joined(self):
        out = self.filtered()
        while True:
            for sign in ("+", "-", "~"):
                if self.take(sign):
                    out = Binary(sign, out, self.filtered())
                    break
            else:
                return out

    def filtered(self):
        out = self.single()
        while self.take("|"):
            name, arguments = self.name(), []
            if self.take("("):
                while not self.take(")"):
                    arguments.append(self.value())
                    if not self.peek(")"):
                        self.need(",")
            out = Filter(name, out, tuple(arguments))
        return out

    def single(self):
        if self.take("("):
            out = self.value()
            self.need(")")
        elif self.take("-"):
            out = Binary("-", Const(0), self.single())
        else:
            kind, word = self.words[self.at] if self.at < len(self.words) else ("end", "")
            self.at += 1
            if kind == "text":
                out = Const(word)
            elif kind == "number":
                out = Const(int(word))
            elif kind == "name":
                out = Const({"true": True, "false": False, "none": None}[word]) if word in ("true", "false", "none") else Name(word)
            else:
                raise TemplateError(f"expected a value, found {word!r}")
        while True:
            if self.take("."):
                out = Field(out, self.name())
            elif self.take("["):
                kind, word = self.words[self.at] if self.at < len(self.words) else ("end", "")
                if kind != "text":
                    raise TemplateError("only a quoted field name may stand in [ ]")
                self.at += 1
                self.need("]")
                out = Field(out, word)
            elif self.peek("("):
                raise TemplateError("calls are not part of the language")
            else:
                return out


def parse(source: str) -> tuple[tuple, tuple[str, ...]]:
    """(nodes, control strings)."""
    parts, at, control = tokens(source), 0, []

    def block(inside: bool, *ends: str) -> tuple[tuple, str, _Parser | None]:
        nonlocal at
        out = []
        while at < len(parts):
            kind, words = parts[at]
            at += 1
            if kind == "text":
                out.append(Text(words))
                continue
            p = _Parser(words)
            if kind == "value":
                out.append(Write(p.value()))
                p.end()
                continue
            tag = p.name()
            if tag in ends:
                return tuple(out), tag, p
            out += statement(tag, p, inside)
            p.end()
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return tuple(out), "", None

    def statement(tag: str, p: _Parser, inside: bool) -> list:
        if tag == "set":
            name = p.name()
            p.need("=")
            return [Set(name, p.value())]
        if tag == "control":
            while True:
                kind, word = p.words[p.at] if p.at < len(p.words) else ("end", "")
                if kind != "text" or not word or "\\" in word:
                    raise TemplateError("control strings are quoted, not empty and hold no backslash")
                control.append(word)
                p.at += 1
                if not p.take(","):
                    return []
        if tag == "for":
            if inside:
                raise TemplateError("the loop over messages stands at the top level")
            name = p.name()
            p.need("in")
            if p.name() != "messages":
                raise TemplateError("only messages can be looped over")
            p.end()
            body, _, last = block(True, "endfor")
            last.end()
            return [Loop(name, body)]
        if tag == "generation":
            p.end()
            body, _, last = block(True, "endgeneration")
            last.end()
            return [Generation(body)]
        if tag == "if":
            tests = [p.value()]
            p.end()
            bodies, other = [], ()
            while True:
                body, end, last = block(True, "elif", "else", "endif")
                bodies.append(body)
                if end == "elif":
                    tests.append(last.value())
                    last.end()
                    continue
                last.end()
                if end == "else":
                    other, _, last = block(True, "endif")
                    last.end()
                break
            for test, body in zip(reversed(tests), reversed(bodies)):
                other = (If(test, body, other),)
            return list(other)
        raise TemplateError(f"unknown tag {tag!r}")

    nodes, _, _ = block(False)
    return nodes, tuple(dict.fromkeys(control))


# ---------------------------------------------------------------------------------------
# values
# ---------------------------------------------------------------------------------------


def _number(value) -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise TemplateError(f"not a number: {value!r}")
    return value


def _add(a, b):
    return a + b if isinstance(a, str) and isinstance(b, str) else _number(a) + _number(b)


def _ordered(test: Callable) -> Callable:
    def run(a, b):
        if isinstance(a, str) != isinstance(b, str) or a is None or b is None:
            raise TemplateError(f"cannot order {a!r} and {b!r}")
        return test(a, b)
    return run


BINARY: dict[str, Callable] = {
    "+": _add, "-": lambda a, b: _number(a) - _number(b), "~": lambda a, b: _shown(a) + _shown(b),
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: _shown(a) in _shown(b),
    "<": _ordered(lambda a, b: a < b), "<=": _ordered(lambda a, b: a <= b),
    ">": _ordered(lambda a, b: a > b), ">=": _ordered(lambda a, b: a >= b),
}


class Escaper:
    """Guards control strings inside texts, reversibly: a backslash before each of them and before
    each backslash.  ``line`` also writes a line feed as backslash n, for values on a line of their own."""

    def __init__(self, control: tuple[str, ...] = ()):
        longest = sorted(control, key=len, reverse=True)
        self._guard = re.compile("|".join([r"\\", *map(re.escape, longest)]))
        #: Text that holds no bare control string.
        self.guarded = r"(?:[^\\]|\\.)*?" if not control else r"(?:\\.|(?!" + "|".join(map(re.escape, longest)) + r")[^\\])*"

    def escape(self, text: str) -> str:
        return self._guard.sub(lambda m: "\\" + m[0], text)

    def line(self, text: str) -> str:
        return self.escape(text).replace("\n", "\\n")

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


# ---------------------------------------------------------------------------------------
# folding
# ---------------------------------------------------------------------------------------


def fold_value(node, known: dict, filters: dict):
    """The same value with every part that depends on constants alone worked out."""
    again = lambda x: fold_value(x, known, filters)
    if isinstance(node, Name):
        return Const(known[node.name]) if node.name in known else node
    if isinstance(node, Field):
        of = again(node.of)
        if isinstance(of, Const):
            if not isinstance(of.value, dict):
                raise TemplateError(f"no field {node.name!r} of {of.value!r}")
            return Const(of.value.get(node.name))
        return Field(of, node.name)
    if isinstance(node, Not):
        value = again(node.value)
        return Const(not value.value) if isinstance(value, Const) else Not(value)
    if isinstance(node, Choice):
        test = again(node.test)
        if isinstance(test, Const):
            return again(node.yes if test.value else node.no)
        return Choice(test, again(node.yes), again(node.no))
    if isinstance(node, Binary):
        left, right = again(node.left), again(node.right)
        if node.sign in ("and", "or"):
            if isinstance(left, Const):
                return right if bool(left.value) == (node.sign == "and") else left
            return Binary(node.sign, left, right)
        if isinstance(left, Const) and isinstance(right, Const):
            return Const(BINARY[node.sign](left.value, right.value))
        # (x ~ "a") ~ "b" is x ~ "ab"
        if node.sign == "~" and isinstance(right, Const) and isinstance(left, Binary) and left.sign == "~" and isinstance(left.right, Const):
            return Binary("~", left.left, Const(_shown(left.right.value) + _shown(right.value)))
        return Binary(node.sign, left, right)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        least, most, function = filters[node.name]
        if not least <= len(node.arguments) <= most:
            raise TemplateError(f"wrong number of arguments for {node.name!r}")
        value, arguments = again(node.value), tuple(map(again, node.arguments))
        if isinstance(value, Const) and all(isinstance(a, Const) for a in arguments):
            return Const(function(value.value, *(a.value for a in arguments)))
        return Filter(node.name, value, arguments)
    return node


def fold(nodes: tuple, known: dict, filters: dict) -> tuple:
    """Constants worked out, branches that never run dropped, neighbouring text joined.  ``known``
    holds the constant names so far and is extended by ``set``."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not (isinstance(node, Text) and not node.text):
            out.append(node)

    for node in nodes:
        if isinstance(node, Write):
            value = fold_value(node.value, known, filters)
            add(Text(_shown(value.value)) if isinstance(value, Const) else Write(value))
        elif isinstance(node, Set):
            value = fold_value(node.value, known, filters)
            if isinstance(value, Const):
                known[node.name] = value.value
            else:
                known.pop(node.name, None)
            # kept: a branch that may not run must not decide about the name for what follows
            add(Set(node.name, value))
        elif isinstance(node, If):
            test = fold_value(node.test, known, filters)
            if isinstance(test, Const):
                for kept in fold(node.yes if test.value else node.no, known, filters):
                    add(kept)
                continue
            yes_known, no_known = dict(known), dict(known)
            add(If(test, fold(node.yes, yes_known, filters), fold(node.no, no_known, filters)))
            for name in set(known) | set(yes_known) | set(no_known):
                same = name in yes_known and name in no_known and type(yes_known[name]) is type(no_known[name]) and yes_known[name] == no_known[name]
                if same:
                    known[name] = yes_known[name]
                else:
                    known.pop(name, None)
        elif isinstance(node, Generation):
            add(Generation(fold(node.body, known, filters)))
        elif isinstance(node, Loop):
            inner = {k: v for k, v in known.items() if k not in (node.name, "loop")}
            add(Loop(node.name, fold(node.body, inner, filters)))
        else:
            add(node)
    return tuple(out)


# ---------------------------------------------------------------------------------------
# closures
# ---------------------------------------------------------------------------------------


@dataclass
class Sink:
    """What a turn has written: pieces of text, their length, and the intervals to learn from."""
    pieces: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _closure(node, names: frozenset[str], filters: dict) -> Callable[[dict], object]:
    make = lambda x: _closure(x, names, filters)
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name
        if name not in names:
            raise TemplateError(f"unknown name {name!r}")
        return lambda env: env[name]
    if isinstance(node, Field):
        of, name = make(node.of), node.name
        if isinstance(node.of, Name) and node.of.name == "loop" and name not in POSITIONS:
            raise TemplateError(f"loop has no {name!r}")

        def get(env):
            record = of(env)
            if not isinstance(record, dict):
                raise TemplateError(f"no field {name!r} of {record!r}")
            return record.get(name)
        return get
    if isinstance(node, Not):
        value = make(node.value)
        return lambda env: not value(env)
    if isinstance(node, Choice):
        test, yes, no = make(node.test), make(node.yes), make(node.no)
        return lambda env: yes(env) if test(env) else no(env)
    if isinstance(node, Binary):
        left, right = make(node.left), make(node.right)
        if node.sign == "and":
            return lambda env: left(env) and right(env)
        if node.sign == "or":
            return lambda env: left(env) or right(env)
        function = BINARY[node.sign]
        return lambda env: function(left(env), right(env))
    if isinstance(node, Filter):
        value, arguments, function = make(node.value), [make(a) for a in node.arguments], filters[node.name][2]
        if not arguments:
            return lambda env: function(value(env))
        return lambda env: function(value(env), *[a(env) for a in arguments])
    raise TemplateError(f"not a value: {node!r}")


def _program(nodes: tuple, names: set[str], filters: dict) -> Callable[[dict, Sink], None]:
    """One closure that runs ``nodes`` in order; ``names`` are the names bound so far."""
    steps: list[Callable] = []
    for node in nodes:
        if isinstance(node, Text):
            steps.append(lambda env, out, text=node.text: out.write(text))
        elif isinstance(node, Write):
            value = _closure(node.value, frozenset(names), filters)
            steps.append(lambda env, out, value=value: out.write(_shown(value(env))))
        elif isinstance(node, Set):
            value = _closure(node.value, frozenset(names), filters)
            names.add(node.name)
            steps.append(lambda env, out, name=node.name, value=value: env.__setitem__(name, value(env)))
        elif isinstance(node, If):
            test = _closure(node.test, frozenset(names), filters)
            with_yes, with_no = set(names), set(names)
            yes, no = _program(node.yes, with_yes, filters), _program(node.no, with_no, filters)
            names |= with_yes & with_no
            steps.append(lambda env, out, test=test, yes=yes, no=no: (yes if test(env) else no)(env, out))
        elif isinstance(node, Generation):
            body = _program(node.body, names, filters)

            def learn(env, out, body=body):
                start = out.length
                body(env, out)
                if out.length > start:
                    out.spans.append((start, out.length))
            steps.append(learn)
        else:
            raise TemplateError("the loop over messages stands at the top level")
    if len(steps) == 1:
        return steps[0]

    def run(env, out):
        for step in steps:
            step(env, out)
    return run


def _asks(node, name: str) -> bool:
    """Whether ``name`` occurs anywhere below."""
    if isinstance(node, tuple):
        return any(_asks(x, name) for x in node)
    if isinstance(node, Name):
        return node.name == name
    return hasattr(node, "__dataclass_fields__") and any(_asks(getattr(node, f), name) for f in node.__dataclass_fields__)


def _generations(nodes: tuple, inside: bool = False) -> None:
    for node in nodes:
        if isinstance(node, Generation):
            if inside:
                raise TemplateError("generation blocks do not nest")
            _generations(node.body, True)
        elif isinstance(node, If):
            _generations(node.yes, inside)
            _generations(node.no, inside)
        elif isinstance(node, Loop):
            _generations(node.body, inside)


class Template:
    """A compiled template.  ``constants`` are names that are fixed for all conversations; they are
    folded into the closures.  A record of a turn is a dict, by default of ``role`` and ``text``.

    Only the source and the constants are pickled: a task compiles the template once."""

    def __init__(self, source: str, constants: dict | None = None):
        self.source, self.constants = source, dict(constants or {})
        parsed, self.control = parse(source)
        self.escaper = Escaper(self.control)
        filters = FILTERS | {"escape": (0, 0, lambda v: self.escaper.escape(_shown(v))), "escape_line": (0, 0, lambda v: self.escaper.line(_shown(v)))}
        self.tree = fold(parsed, dict(self.constants), filters)
        _generations(self.tree)
        loops = [i for i, n in enumerate(self.tree) if isinstance(n, Loop)]
        if len(loops) > 1:
            raise TemplateError("a template reads its messages once")
        at = loops[0] if loops else len(self.tree)
        self.positional = bool(loops) and _asks(self.tree[at].body, "loop")
        names = set(self.constants)
        head = _program(self.tree[:at], names, filters)
        self._env, out = dict(self.constants), Sink()
        head(self._env, out)  # nothing before the loop can depend on a conversation
        self.head = "".join(out.pieces), out.spans
        self._name = self.tree[at].name if loops else ""
        self._turn = _program(self.tree[at].body, names | {self._name, "loop"}, filters) if loops else None
        out = Sink()
        _program(self.tree[at + 1:], names, filters)(dict(self._env), out)
        self.tail = "".join(out.pieces), out.spans

    def __reduce__(self):
        return Template, (self.source, self.constants)

    def turn(self, record: dict, loop: dict | None = None) -> tuple[str, list[tuple[int, int]]]:
        """(text of one turn, intervals of code points in it that a model learns from)."""
        if self._turn is None:
            return "", []
        out, env = Sink(), dict(self._env)
        env[self._name], env["loop"] = record, loop or {}
        self._turn(env, out)
        return "".join(out.pieces), out.spans

    def render(self, records: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        """(text, intervals) of one conversation held in memory."""
        pieces, spans, length = [], [], 0
        turns = [self.turn(r, {"index0": i, "index": i + 1, "first": i == 0, "last": i == len(records) - 1}) for i, r in enumerate(records)]
        for text, own in [self.head, *turns, self.tail]:
            pieces.append(text)
            spans += [(a + length, b + length) for a, b in own]
            length += len(text)
        return "".join(pieces), spans
