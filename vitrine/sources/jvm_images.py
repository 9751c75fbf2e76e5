"""Spark's own image decoder as a column expression.

The image source makes an encoder and its code anew for every file, which costs several times what decoding does, and its
driver holds the list of all files. The decoder behind it (``ImageSchema.decode``) has no SQL function; here it is called by
the expressions that typed Datasets call their methods with, so bytes from anywhere are decoded in the JVM, just as there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCHEMA = "org.apache.spark.ml.image.ImageSchema$"
_ROW = "org.apache.spark.sql.Row"
_FIELDS = ("origin", "height", "width", "nChannels", "mode", "data")


class _Expressions:
    """The JVM's expressions: calls of methods and fields of rows."""

    def __init__(self, jvm):
        self._jvm = jvm
        self.catalyst = jvm.org.apache.spark.sql.catalyst.expressions
        self.boolean = jvm.java.lang.Boolean.TYPE
        self._bridge = jvm.org.apache.spark.sql.classic.ExpressionUtils

    def kind(self, name: str):
        return self._jvm.org.apache.spark.sql.types.ObjectType(self._class(name))

    def _class(self, name: str):
        return self._jvm.org.apache.spark.util.Utils.classForName(name, True, False)

    def _seq(self, items: tuple):
        listed = self._jvm.java.util.ArrayList()
        for item in items:
            listed.add(item)
        return self._jvm.scala.jdk.javaapi.CollectionConverters.asScala(listed).toSeq()

    def of(self, column: Column):
        return self._bridge.expression(column._jc)

    def column(self, expression) -> Column:
        return Column(self._bridge.column(expression))

    def text(self, value: str):
        return self.catalyst.Literal.fromObject(value, self.kind("java.lang.String"))

    def array(self, of: str, *items):
        kind = self._class(of)
        made = self._jvm.java.lang.reflect.Array.newInstance(kind, len(items))
        for place, item in enumerate(items):
            self._jvm.java.lang.reflect.Array.set(made, place, item)
        return self.catalyst.Literal.fromObject(made, self._jvm.org.apache.spark.sql.types.ObjectType(made.getClass()))

    def call(self, target, method: str, kind, *arguments):
        # A null argument is one that the method gets.
        return self.catalyst.objects.Invoke(target, method, kind, self._seq(arguments), self._seq(()), False, True, True)

    def call_static(self, of: str, method: str, kind, *arguments):
        none = getattr(self._jvm.scala, "None$").__getattr__("MODULE$")
        return self.catalyst.objects.StaticInvoke(
            self._class(of), kind, method, self._seq(arguments), self._seq(()), True, True, True, none)

    def unwrapped(self, option, kind):
        return self.catalyst.objects.UnwrapOption(kind, option)

    def field(self, row, place: int, name: str, kind, held):
        objects = self.catalyst.objects
        return objects.ValidateExternalType(objects.GetExternalRowField(row, place, name), kind, held)


def with_decoded(files: DataFrame, schema, origin: str = "origin", content: str = "content") -> DataFrame:
    """``image``: structs of the fields of ``schema`` (that of the image source), invalid ones where nothing can be read."""
    e = _Expressions(files.sparkSession._jvm)
    named = lambda name: e.call_static("java.lang.Class", "forName", e.kind("java.lang.Class"), e.text(name))
    # Bytes are in memory already; by default ImageIO makes a temporary file of each picture as well. The call gives null.
    setter = e.call(named("javax.imageio.ImageIO"), "getMethod", e.kind("java.lang.reflect.Method"), e.text("setUseCache"),
                    e.array("java.lang.Class", e.boolean))
    uncached = e.call(setter, "invoke", e.kind("java.lang.Object"), e.text(""), e.array("java.lang.Object", False))
    # The decoder is a method of a Scala object, which is reached by the static field that holds it; of whom it is asked is ignored.
    decoder = e.call(e.call(named(_SCHEMA), "getField", e.kind("java.lang.reflect.Field"), e.text("MODULE$")),
                     "get", e.kind(_SCHEMA), uncached)
    name = e.call(e.of(F.col(origin)), "toString", e.kind("java.lang.String"))
    found = e.unwrapped(e.call(decoder, "decode", e.kind("scala.Option"), name, e.of(F.col(content))), e.kind(_ROW))
    rows = files.select(origin, e.column(found).alias("_row"))

    kinds = files.sparkSession._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json())
    image = e.field(e.of(F.col("_row")), 0, "image", kinds, e.kind(_ROW))
    values = []
    for place, field in enumerate(_FIELDS):
        kind = kinds.apply(place).dataType()
        if field == "origin":
            held = e.field(image, place, field, kind, e.kind("java.lang.String"))
            value = e.call_static("org.apache.spark.unsafe.types.UTF8String", "fromString", kind, held)
        else:
            value = e.field(image, place, field, kind, kind)
        values.append(e.column(value).alias(field))
    nothing = [F.lit(-1).alias(field) for field in _FIELDS[1:5]]
    invalid = F.struct(F.col(origin).alias("origin"), *nothing, F.lit(b"").alias("data"))
    return rows.select(F.when(F.col("_row").isNull(), invalid).otherwise(F.struct(*values)).alias("image"))
