"""Labelled catalogs: headers, grades, classification paths, record texts and heuristic labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, class_parts, compose, norm, strip

# For each canonical header, in order, what the name contains or is equal to.
HEADER_RULES = (
    ("dbname", ("数据库名", "dbname"), ()), ("tablename", ("数据表名", "tablename"), ("表名",)),
    ("fieldname", ("字段名",), ("字段", "fieldname", "time")), ("fielddesc", ("字段描述", "fielddesc"), ("描述",)),
    ("datatype", ("数据类型", "datatype"), ("类型",)), ("length", ("最大长度", "length"), ()),
    ("null", ("可为空", "null"), ()), ("keyflag", ("主键", "外键", "pk", "fk"), ()), ("enum", ("枚举", "enum"), ()),
    ("example", ("数据示例", "example"), ("示例",)), ("classification", ("分类",), ()), ("grade", ("分级", "grade"), ()),
)
# Domains by a part of a file name, in order.
DOMAINS = (
    ("通用", "general"), ("法律", "legal"), ("金融", "finance"), ("气象", "meteorology"), ("政务", "government"), ("政府", "government"),
    ("科学", "science"), ("科研", "science"), ("医疗", "healthcare"), ("医疗卫生", "healthcare"), ("教育", "education"),
    ("交通", "transportation"), ("能源", "energy"), ("环境", "environment"), ("农业", "agriculture"),
)
# Words in name and comment, a pattern of the sample, and the four labels they stand for.
PERSONAL = "个人信息"
LABEL_RULES = (
    (("手机号", "手机", "mobile", "phone"), r"(?<!\d)1[3-9]\d{9}(?!\d)", ("个人联系信息", "手机号码", "手机号(中国内地)")),
    (("邮箱", "email", "mail"), r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", ("个人联系信息", "邮箱", "邮箱地址(中国内地)")),
    (("身份证", "id_card", "identity"), r"\b\d{17}[\dXx]\b", ("个人身份鉴别信息", "身份证件信息", "身份证号(中国内地)")),
    (("订单编号", "order_no", "order"), r"\border\d+\b", ("个人财产信息", "个人交易信息", "订单编号")),
    (("qq", "wechat", "weixin", "社交"), None, ("个人联系信息", "社交软件账号", "qq")),
)
FIELDS = {  # canonical fields and the columns that may hold them
    "dbname": ("dbname",), "tablename": ("tablename", "表名"), "fieldname": ("fieldname", "time", "字段名"), "fielddesc": ("fielddesc", "字段描述"),
    "example": ("example", "数据示例", "示例"), "datatype": ("datatype", "数据类型"), "null": ("null", "可空", "NULL"),
    "classification": ("classification", "分类"), "grade": ("grade", "分级"),
}


def header_key(name: Column) -> Column:
    """The canonical form of a header; one that no rule knows stays, in lower case without spaces."""
    s = F.translate(F.lower(strip(F.coalesce(name, F.lit("")))), "（） ", "()")
    out = s
    for key, inside, equal in reversed(HEADER_RULES):
        test = F.lit(False)
        for w in inside:
            test = test | s.contains(w)
        out = F.when(test | s.isin(*equal) if equal else test, F.lit(key)).otherwise(out)
    return out


def canonical_names(df: DataFrame) -> DataFrame:
    """df with canonical headers; columns that would share one become one, the first that isn't null."""
    spark = df.sparkSession
    names = [r[0] for r in spark.createDataFrame([(i, c) for i, c in enumerate(df.columns)], "i int, c string").select("i", header_key(F.col("c")).alias("k")).orderBy("i").select("k").collect()]  # one row per column
    by: dict[str, list[int]] = {}
    for i, (k, c) in enumerate(zip(names, df.columns)):
        by.setdefault(k or c, []).append(i)
    plain = df.toDF(*(f"_{i}" for i in range(len(names))))
    return plain.select(*(F.coalesce(*(F.col(f"_{i}").cast("string") for i in at)).alias(k) for k, at in by.items()))


def canonical_rows(df: DataFrame) -> DataFrame:
    """The nine canonical fields of canonically named rows, stripped; the first alias that exists counts, null or not."""
    pick = lambda names: next((strip(F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(""))) for n in names if n in df.columns), F.lit(""))
    return df.select(*(pick(names).alias(f) for f, names in FIELDS.items()))


def labelled(rows: DataFrame) -> DataFrame:
    """Canonical rows that have a name or description, and a classification."""
    return rows.where("(fieldname <> '' or fielddesc <> '') and classification <> ''")


def record_text() -> Column:
    """A canonical row as one labelled text."""
    plain = [F.when(F.col(c) != "", F.col(c)) for c in ("tablename", "fieldname")]
    rest = compose({"描述": F.col("fielddesc"), "示例": F.col("example"), "类型": F.col("datatype"), "可空": F.col("null"), "分级": F.col("grade")})
    return F.concat_ws(" | ", *plain, F.nullif(rest, F.lit("")))


def grade(raw: Column) -> Column:
    """S1 to S4 from any notation; '' for blank, null where nothing is recognised."""
    text = F.coalesce(raw, F.lit(""))
    s = F.replace(F.upper(text), F.lit(" "), F.lit(""))
    out = F.lit(None).cast("string")
    for i, han in reversed(list(enumerate("一二三四", 1))):
        out = F.when(s.contains(f"G-{i}") | s.contains(f"G{i}") | F.upper(text).contains(f"{han}级"), f"S{i}").otherwise(out)
    for i in (4, 3, 2, 1):
        out = F.when(s.contains(f"S{i}"), f"S{i}").otherwise(out)
    return F.when(text == "", "").otherwise(out)


def level_number(level: Column) -> Column:
    """1 to 4 for exactly s1 to s4 in any case, white space around it apart, else 0."""
    out = F.lit(0)
    for i in (1, 2, 3, 4):
        out = F.when(norm(level) == f"s{i}", i).otherwise(out)
    return out


def domain(name: Column, table: tuple[tuple[str, str], ...] = DOMAINS) -> Column:
    """The first domain whose word the name contains, else general."""
    out = F.lit("general")
    for word, d in reversed(table):
        out = F.when(name.contains(word), d).otherwise(out)
    return out


def parse_classification(rows: DataFrame, raw: str, taxonomy: DataFrame) -> DataFrame:
    """rows with domain, sub1 and sub2, from taxonomy(domain, sub1, sub2, ord).

    Three segments stand as they are, two or one are completed from the taxonomy: a domain first, then
    a first-level name under its first domain, then a second-level name under its last place; else null.
    """
    from ..session import checked_broadcast

    dom = checked_broadcast(taxonomy.select(F.col("domain").alias("_d")).where("_d is not null").distinct())
    s1 = checked_broadcast(taxonomy.where("sub1 is not null").groupBy(F.col("sub1").alias("_s1")).agg(F.min_by("domain", "ord").alias("_s1d")))
    s2 = checked_broadcast(taxonomy.where("sub2 is not null").groupBy(F.col("sub2").alias("_s2")).agg(F.max_by(F.struct("domain", "sub1"), "ord").alias("_s2p")))
    p = rows.withColumn("_p", class_parts(raw)).withColumn("_n", F.size("_p")).withColumn("_a", F.get("_p", 0)).withColumn("_b", F.when(F.col("_n") == 2, F.get("_p", 1)).when(F.col("_n") == 1, F.get("_p", 0)))
    j = p.join(dom, p["_a"] == dom["_d"], "left").join(s1, F.col("_b") == F.col("_s1"), "left").join(s2, F.col("_b") == F.col("_s2"), "left")
    none = F.lit(None).cast("string")
    make = lambda d, a, b: F.struct(d.alias("d"), a.alias("s1"), b.alias("s2"))
    short = F.col("_n").isin(1, 2)
    got = (
        F.when(F.col("_n") == 3, make(F.get("_p", 0), F.get("_p", 1), F.get("_p", 2)))
        .when(short & F.col("_d").isNotNull(), make(F.col("_a"), F.when(F.col("_n") == 2, F.col("_b")), none))
        .when(short & F.col("_s1").isNotNull(), make(F.col("_s1d"), F.col("_b"), none))
        .when(short & F.col("_s2").isNotNull(), make(F.col("_s2p.domain"), F.col("_s2p.sub1"), F.col("_b")))
    )
    return j.withColumn("_g", got).select(*(rows[c] for c in rows.columns), F.col("_g.d").alias("domain"), F.col("_g.s1").alias("sub1"), F.col("_g.s2").alias("sub2"))


def taxonomy_json(taxonomy: DataFrame) -> DataFrame:
    """(domain, body): each domain of taxonomy(domain, sub1, sub2) as nested JSON."""
    below = taxonomy.groupBy("domain", "sub1").agg(F.array_sort(F.collect_set("sub2")).alias("sub2s"))
    tree = below.groupBy("domain").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sub1", "sub2s")))).alias("m"))
    return tree.select("domain", F.to_json(F.struct(F.create_map("domain", F.struct(F.col("m").alias("一级子类"))).alias("domains"))).alias("body"))


def read_taxonomy(documents: DataFrame, body: str) -> DataFrame:
    """(domain, sub1, sub2) of label taxonomies as nested JSON, a row per second-level name."""
    parsed = documents.select(F.from_json(body, "domains map<string, struct<`一级子类`: map<string, array<string>>>>").alias("t"))
    one = parsed.select(F.explode("t.domains").alias("domain", "d")).select("domain", F.explode(F.col("d.`一级子类`")).alias("sub1", "s"))
    return one.select("domain", "sub1", F.explode("s").alias("sub2"))


def heuristic_labels(name: Column, comment: Column, sample: Column) -> Column:
    """struct(l1, l2, l3, marker) by words in comment and name, then by the sample's pattern; nulls if none."""
    words = F.concat(F.lower(F.coalesce(comment, F.lit(""))), F.lower(F.coalesce(name, F.lit(""))))
    value = F.lower(F.coalesce(sample, F.lit("")))
    make = lambda v: F.struct(*(F.lit(x).cast("string").alias(k) for k, x in zip(("l1", "l2", "l3", "marker"), v)))
    out = make((None,) * 4)
    for _, rx, v in reversed(LABEL_RULES):
        if rx:
            out = F.when(value.rlike(rx), make((PERSONAL, *v))).otherwise(out)
    for ws, _, v in reversed(LABEL_RULES):
        test = F.lit(False)
        for w in ws:
            test = test | words.contains(w)
        out = F.when(test, make((PERSONAL, *v))).otherwise(out)
    return out


def training_records(rows: DataFrame, source: Column, taxonomy: DataFrame) -> DataFrame:
    """(source, dbname, tablename, fieldname, text, domain, sub1, sub2, grade) of labelled canonical rows."""
    r = labelled(rows).withColumns({"text": record_text(), "source": source})
    p = parse_classification(r, "classification", taxonomy)
    return p.select("source", "dbname", "tablename", "fieldname", "text", "domain", "sub1", "sub2", grade(F.col("grade")).alias("grade"))


def normalized(x: Column) -> Column:
    return blank_to_null(x)
