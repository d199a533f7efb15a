"""Rows with characters beyond ASCII."""

from ordermill.plans import reference, reference_more


def run(spark, folder, name, table, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    return {tuple(r) for r in reference.QUERIES[name][0](spark, str(folder)).collect()}


def test_numbers(spark, tmp_path):
    rows = [("１２",), (" 5　",), ("1２3,5",), ("1 500 kg",), ("7",), (None,)]
    got = run(spark, tmp_path, "number_parsers", "po_line_items", rows, "quantity string")
    assert got == {("１２", 12.0, 12.0, 12.0), (" 5　", 5.0, 5.0, 5.0), ("1２3,5", 1235.0, 123.5, 123.5), ("1 500 kg", None, 1500.0, 1.0), ("7", 7.0, 7.0, 7.0)}


def test_postcodes(spark, tmp_path):
    rows = [(1, "Müllerstraße 3\n80331 München"), (2, "5 High St, 12345 X"), (3, None), (4, "Łódź 90-001")]
    assert run(spark, tmp_path, "postcode_extract", "po_headers", rows, "record_id long, ship_to_address string") == {(1, "80331"), (2, "12345"), (4, "90-001")}


def test_markers(spark, tmp_path):
    rows = [(1, "１", "Stück", "n/a", " "), (2, None, "-", "ab", "x")]
    assert run(spark, tmp_path, "markers_to_null", "po_line_items", rows, "line_id long, quantity string, unit string, material_code string, delivery_date string") == {(1, "１", "Stück", None, None), (2, None, None, "ab", "x")}
