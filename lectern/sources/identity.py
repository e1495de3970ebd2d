"""What a table is made from, as one digest.

A digest is the same in every run and process as long as plan, input files,
functions and values are, and different when any of them changes.  Where this
cannot be known, such as for rows in the driver's memory, it is never the same
again, so that a table is built anew rather than an old one taken.
"""

from __future__ import annotations

import dataclasses
import functools
import hashlib
import json
import sys
import sysconfig
import types
from collections.abc import Iterable, Iterator, Mapping, Set

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from lectern.session import hadoop_path

_EXPR_ID = "org.apache.spark.sql.catalyst.expressions.ExprId"
#: Node fields that Spark numbers anew in each plan and that do not change its result.
_NUMBERED = {"UnresolvedNamedLambdaVariable": ("nameParts",), "NamedLambdaVariable": ("name",), "Alias": ("nonInheritableMetadataKeys",)}
_DATASET_KEYS = ("__dataset_id", "__col_position")
#: Entries of a class that Python adds or that say nothing of what it does.
_OF_CLASSES = (
    "__dict__", "__weakref__", "__module__", "__doc__", "__firstlineno__", "__static_attributes__", "__slotnames__", "_abc_impl")
_INSTALLED = tuple({sysconfig.get_path(p) for p in ("stdlib", "platstdlib", "purelib", "platlib")})


@dataclasses.dataclass(frozen=True)
class Files:
    """The files under some paths, by name, size and time."""

    spark: SparkSession
    paths: tuple[str, ...]

    def __made_from__(self) -> list:
        return list(self._listed())

    def _listed(self) -> Iterator[tuple]:
        for path in self.paths:
            fs, target = hadoop_path(self.spark, path)
            for top in fs.globStatus(target) or []:
                if top.isFile():
                    yield top.getPath().toString(), top.getLen(), top.getModificationTime()
                    continue
                files = fs.listFiles(top.getPath(), True)
                held = []
                while files.hasNext():
                    one = files.next()
                    held.append((one.getPath().toString(), one.getLen(), one.getModificationTime()))
                yield from sorted(held)


def _numbered_again(value: object, seen: dict) -> object:
    """A plan's tree with expression ids in order of appearance and without names that Spark draws."""
    if isinstance(value, list):
        return [_numbered_again(v, seen) for v in value]
    if not isinstance(value, dict):
        return value
    if value.get("product-class") == _EXPR_ID:
        return {"id": seen.setdefault((value["id"], value["jvmId"]), len(seen))}
    drop = _NUMBERED.get(str(value.get("class", "")).rpartition(".")[2], ())
    return {k: _numbered_again(v, seen) for k, v in value.items() if k not in drop and k not in _DATASET_KEYS}


def _items(seq) -> Iterator:
    """The elements of a Scala sequence."""
    for i in range(seq.size()):
        yield seq.apply(i)


def _python_functions(node) -> Iterator[str]:
    """The pickled functions in a plan or expression, which its tree form leaves out."""
    if node.getClass().getSimpleName() == "PythonUDF":
        yield node.func().command().mkString(",")
    if hasattr(node, "expressions") and "plans" in node.getClass().getName():
        for expression in _items(node.expressions()):
            yield from _python_functions(expression)
    for child in _items(node.children()):
        yield from _python_functions(child)


def _source(spark: SparkSession, leaf) -> object:
    """What a leaf of a plan reads, beyond its tree form."""
    kind = leaf.getClass().getSimpleName()
    if kind == "LogicalRelation":
        relation = leaf.relation()
        if relation.getClass().getSimpleName() != "HadoopFsRelation":
            return relation.toString()
        return [
            relation.fileFormat().getClass().getName(), relation.options().toString(), relation.dataSchema().json(),
            relation.partitionSchema().json(), relation.location().rootPaths().mkString("\n")]
    if kind == "LogicalRDD":
        return ["rdd", spark.sparkContext.applicationId, leaf.rdd().id()]
    if kind == "LocalRelation":
        return leaf.data().mkString("\n")
    return leaf.toString() if kind not in ("Range", "OneRowRelation") else kind


def plan_digest(df: DataFrame) -> str:
    """Digest of a plan, its functions, its schema, its sources and their files.

    The plan is Spark's own tree form, whole, with expression ids numbered by
    appearance; no text is cut or replaced.  Seeds drawn for an unseeded
    ``rand`` are part of it, so such a plan is never the same again.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    text = plan.toJSON()
    known: list = [_numbered_again(json.loads(text), {}), df.schema.jsonValue()]
    known.append([_source(spark, leaf) for leaf in _items(plan.collectLeaves())])
    if ".PythonUDF" in text:
        known.append(sorted(_python_functions(plan)))
    for name in sorted(df.inputFiles()):
        fs, target = hadoop_path(spark, name)
        status = fs.getFileStatus(target)
        known.append([name, status.getLen(), status.getModificationTime()])
    return hashlib.sha256(json.dumps(known, sort_keys=True).encode()).hexdigest()


def _is_installed(module: str) -> bool:
    """Modules of Python, of installed packages and of this library count by name."""
    if module.partition(".")[0] == __name__.partition(".")[0] or module in sys.builtin_module_names:
        return True
    where = getattr(sys.modules.get(module), "__file__", None)
    return where is not None and where.startswith(_INSTALLED)


class _Digester:
    """Feeds the parts of values to one hash; what is met again is named by its number."""

    def __init__(self) -> None:
        self.hash = hashlib.sha256()
        self.met: dict[int, int] = {}
        self.kept: list = []  # so that no id is used twice

    def put(self, *parts: object) -> None:
        for part in parts:
            data = part if isinstance(part, bytes) else str(part).encode("utf-8", "surrogatepass")
            self.hash.update(b"%d:" % len(data) + data)

    def many(self, values: Iterable) -> None:
        values = list(values)
        self.put(len(values))
        for value in values:
            self.add(value)

    def add(self, value: object) -> None:
        if value is None or isinstance(value, (bool, int, float, complex, str, bytes)):
            self.put(type(value).__name__, value if isinstance(value, (str, bytes)) else repr(value))
            return
        if id(value) in self.met:
            self.put("again", self.met[id(value)])
            return
        self.met[id(value)] = len(self.met)
        self.kept.append(value)
        if isinstance(value, DataFrame):
            self.put("table", plan_digest(value))
        elif isinstance(value, SparkSession):
            self.put("session")
        elif isinstance(value, T.DataType):
            self.put("type", value.json())
        elif isinstance(value, Column):
            raise TypeError("a column says nothing without its table: name what the table is made from")
        elif hasattr(value, "__made_from__") and not isinstance(value, type):
            self.put(type(value).__qualname__)
            self.add(value.__made_from__())
        elif isinstance(value, Mapping):
            self.put("mapping", len(value))
            for key in sorted(value, key=digest):
                self.many([key, value[key]])
        elif isinstance(value, Set):
            self.put("set", len(value), *sorted(map(digest, value)))
        elif isinstance(value, (list, tuple)):
            self.put(type(value).__name__)
            self.many(value)
        elif isinstance(value, types.ModuleType):
            self.put("module", value.__name__)
        elif isinstance(value, types.CodeType):
            self._code(value)
        elif isinstance(value, types.MethodType):
            self.put("method")
            self.many([value.__func__, value.__self__])
        elif isinstance(value, functools.partial):
            self.put("partial")
            self.many([value.func, value.args, value.keywords])
        elif isinstance(value, (types.FunctionType, type)) and _is_installed(value.__module__) and "<locals>" not in value.__qualname__:
            self.put("named", value.__module__, value.__qualname__)
        elif isinstance(value, types.FunctionType):
            self._function(value)
        elif isinstance(value, type):
            self.put("class", value.__qualname__)
            self.many(value.__bases__)
            for name in sorted(set(vars(value)) - set(_OF_CLASSES)):
                self.put(name)
                self.add(vars(value)[name])
        elif isinstance(value, (staticmethod, classmethod)):
            self.add(value.__func__)
        elif isinstance(value, property):
            self.many([value.fget, value.fset, value.fdel])
        elif isinstance(value, (types.BuiltinFunctionType, types.MethodDescriptorType, types.WrapperDescriptorType)):
            self.put("builtin", getattr(value, "__module__", None), value.__qualname__)
        else:
            self._object(value)

    def _code(self, code: types.CodeType) -> None:
        # Neither file nor line: moving a function does not change it.
        self.put("code", code.co_code, code.co_names, code.co_varnames, code.co_freevars, code.co_argcount, code.co_flags)
        self.many(code.co_consts)

    def _function(self, function: types.FunctionType) -> None:
        self.put("function", function.__name__)
        self._code(function.__code__)
        self.many([function.__defaults__, function.__kwdefaults__])
        self.many(cell.cell_contents for cell in function.__closure__ or ())
        names = sorted(_global_names(function.__code__) & set(function.__globals__))
        self.put(*names)
        self.many(function.__globals__[n] for n in names)

    def _object(self, value: object) -> None:
        self.put("object")
        self.add(type(value))
        reduced = value.__reduce_ex__(2)
        if isinstance(reduced, str):
            self.put(reduced)
            return
        self.many(part if not isinstance(part, Iterator) else list(part) for part in reduced)


def _global_names(code: types.CodeType) -> set[str]:
    names = set(code.co_names)
    for constant in code.co_consts:
        if isinstance(constant, types.CodeType):
            names |= _global_names(constant)
    return names


def digest(*values: object) -> str:
    """One digest of tables, functions with all they refer to, objects and plain values.

    A function counts by its code, defaults, closure and the globals it names,
    down to installed packages, which count by name.  An object may say what it
    counts by with ``__made_from__``; any other counts by its class and state,
    and raises ``TypeError`` where it has none that can be read.
    """
    digester = _Digester()
    digester.many(values)
    return digester.hash.hexdigest()
