"""Models as nodes that name their inputs (S10): tables or views, built in the order of their inputs and only where out of date.

A node's fingerprint is made of its code (the text of its build function and of the modules that it uses), its parameters
and the fingerprints of its inputs; a source's is the state of its files.  A table is a versioned one (S8) whose commit notes the fingerprint: a
run rebuilds it only if that has changed, holds it against its checks before it is put in place, and leaves it alone otherwise.  A
view is only a plan and is never written.
"""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelanes.sources import versions

PACKAGE = __name__.split(".")[0]
TABLE, VIEW = "table", "view"


@dataclass(frozen=True)
class Source:
    """Data that comes from elsewhere: ``load`` it, and its ``state``, a text that changes when the data does."""

    name: str
    load: Callable[[], DataFrame]
    state: Callable[[], str]


@dataclass(frozen=True)
class Node:
    """A model: ``build`` takes the frames of ``inputs`` in their order.  ``check`` gets the built frame and the input frames, and raises if
    it must not be put in place.  ``params`` are what the build depends on besides its inputs."""

    name: str
    build: Callable[..., DataFrame]
    inputs: Sequence[str] = ()
    materialized: str = TABLE
    partition_cols: Sequence[str] = ()
    check: Callable[..., None] | None = None
    params: tuple = ()
    layout: Callable[[DataFrame], DataFrame] | None = None  # arranges the rows for readers
    options: tuple[tuple[str, str], ...] = ()  # of the writer


def files_state(spark: SparkSession, path: str) -> str:
    """Number, bytes and a hash of the names, lengths and times of the files below a path; no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    state = listed.agg(F.count(F.lit(1)), F.sum("length"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return ":".join(str(v) for v in state)


def _modules(module: ModuleType | None, found: dict[str, ModuleType]) -> dict[str, ModuleType]:
    """The modules of this package that a module uses, itself included."""
    if module is None or module.__name__.split(".")[0] != PACKAGE or module.__name__ in found:
        return found
    found[module.__name__] = module
    for value in list(vars(module).values()):
        _modules(value if isinstance(value, ModuleType) else inspect.getmodule(value) if callable(value) else None, found)
    return found


def code_state(build: Callable) -> str:
    """Digest of the code that a function can reach: its own text, the modules of this package whose functions it names, and the
    values of the constants it names."""
    found: dict[str, ModuleType] = {}
    texts = [inspect.getsource(build)]
    for name in build.__code__.co_names:
        value = build.__globals__.get(name)
        if isinstance(value, ModuleType) or callable(value):
            _modules(value if isinstance(value, ModuleType) else inspect.getmodule(value), found)
        elif value is not None:
            texts.append(f"{name}={value!r}")
    texts += [inspect.getsource(m) for _, m in sorted(found.items())]
    return hashlib.sha256("\n".join(texts).encode()).hexdigest()


class Graph:
    """Nodes and sources by name, over a base folder that keeps the tables."""

    def __init__(self, spark: SparkSession, base: str, parts: Sequence[Node | Source]):
        self.spark, self.base, self.parts = spark, base, {p.name: p for p in parts}
        self.frames: dict[str, DataFrame] = {}
        self.prints: dict[str, str] = {}
        self.written: list[str] = []  # by this run

    def order(self, targets: Sequence[str]) -> list[str]:
        """The targets and all they need, inputs first.  An unknown input or a circle is an error."""
        done: list[str] = []

        def visit(name: str, on_the_way: tuple[str, ...]) -> None:
            if name in on_the_way:
                raise ValueError("circle: " + " -> ".join([*on_the_way[on_the_way.index(name):], name]))
            if name not in self.parts:
                raise KeyError(f"{on_the_way[-1] if on_the_way else 'the run'} needs {name}, which is no node")
            if name not in done:
                for needed in getattr(self.parts[name], "inputs", ()):
                    visit(needed, (*on_the_way, name))
                done.append(name)

        for target in targets:
            visit(target, ())
        return done

    def run(self, *targets: str) -> dict[str, DataFrame]:
        """Bring the targets up to date (default: all nodes) and return the frames of all that they needed, inputs first.
        Tables and views can be read in SQL under their names."""
        for name in self.order(targets or [n for n, p in self.parts.items() if isinstance(p, Node)]):
            if name in self.frames:
                continue
            part = self.parts[name]
            if isinstance(part, Source):
                self.frames[name], self.prints[name] = part.load(), part.state()
            else:
                self._bring(part)
            self.frames[name].createOrReplaceTempView(name)
        return dict(self.frames)

    def _bring(self, node: Node) -> None:
        inputs = [self.frames[i] for i in node.inputs]
        of = [code_state(node.build), repr(node.params), node.materialized, *node.partition_cols, *(self.prints[i] for i in node.inputs)]
        self.prints[node.name] = mark = hashlib.sha256(json.dumps(of).encode()).hexdigest()
        check = None if node.check is None else lambda built: node.check(built, *inputs)
        if node.materialized == VIEW:
            built = node.build(*inputs)
            if check:
                check(built)
            self.frames[node.name] = built
            return
        path = f"{self.base}/{node.name}"
        known = versions.commit(self.spark, path)
        if known is None or known.info.get("fingerprint") != mark:
            built = node.build(*inputs)
            try:
                versions.replace(node.layout(built) if node.layout else built, path, node.partition_cols, known.version if known else 0, check,
                                 {"fingerprint": mark}, whole=True, arranged=node.layout is not None, options=dict(node.options))
                self.written.append(node.name)
            except versions.CommitConflict:  # another run has built it meanwhile, from the same inputs or not
                if versions.commit(self.spark, path).info.get("fingerprint") != mark:
                    raise
        self.frames[node.name] = versions.read(self.spark, path)
