import pytest
from conftest import rows

from tillstar import load_tables
from tillstar.schemas import TABLE_SCHEMAS, conform
from tillstar.sources import read_csv_table

HEADERS = {name: ",".join(schema.fieldNames()) for name, schema in TABLE_SCHEMAS.items()}
LINES = {
    "customers": ["c1,Ann,Lee,a@x.org,Norway", "c2,Bo,Ray,,"],
    "products": ["p1,Lamp,Home Goods,BrandA", "p2,Ball,Sports,Generic"],
    "orders": ["o1,c1,2023-01-05 10:00:00,20.5,completed", "o2,c2,junk,x,pending"],
    "order_items": ["i1,o1,p1,2,10.25", "i2,o2", "i3,o2,p2,one,3.0,extra", 'i4,o2,"",1,']
}


def write(path, **changed):
    for name, header in HEADERS.items():
        text = "\n".join([changed.get(name, header), *LINES[name]]) + "\n"
        (path / f"{name}.csv").write_text(text)
    return str(path)


def test_csv_tables_have_the_declared_schemas(spark, tmp_path):
    tables = load_tables(spark, write(tmp_path))
    for name, df in tables._asdict().items():
        assert df.schema == TABLE_SCHEMAS[name]
    assert rows(tables.customers)[1] == ("c2", "Bo", "Ray", None, None)


def test_bad_cells_are_null_short_rows_padded_extra_cells_cut(spark, tmp_path):
    tables = load_tables(spark, write(tmp_path))
    assert rows(tables.order_items) == [
        ("i1", "o1", "p1", 2, 10.25),
        ("i2", "o2", None, None, None),
        ("i3", "o2", "p2", None, 3.0),
        ("i4", "o2", None, 1, None),
    ]
    assert tables.orders.collect()[1].total_amount is None


def test_swapped_header_fails(spark, tmp_path):
    path = write(tmp_path, products="product_name,product_id,category,brand")
    with pytest.raises(Exception, match="header does not conform"):
        load_tables(spark, path).products.collect()


def test_every_file_of_a_directory_is_checked(spark, tmp_path):
    many = tmp_path / "many" / "products.csv"
    many.mkdir(parents=True)
    (many / "a.csv").write_text(HEADERS["products"] + "\np1,Lamp,Home,A\n")
    (many / "b.csv").write_text("product_id,name,category,brand\np2,Ball,Sports,B\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_csv_table(spark, str(tmp_path / "many"), "products").collect()


def test_parquet_tables_keep_types_and_check_columns(spark, tmp_path):
    source = load_tables(spark, write(tmp_path))
    for name, df in source._asdict().items():
        df.select(*reversed(df.columns)).write.parquet(str(tmp_path / "pq" / f"{name}.parquet"))
    tables = load_tables(spark, str(tmp_path / "pq"), "parquet")
    for name, df in tables._asdict().items():
        assert df.schema == TABLE_SCHEMAS[name]
        assert sorted(map(repr, rows(df))) == sorted(map(repr, rows(getattr(source, name))))
    with pytest.raises(ValueError, match="lacks columns"):
        conform(tables.orders.drop("status"), "orders")


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unknown source format"):
        load_tables(spark, "/nowhere", "xml")
