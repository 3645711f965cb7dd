from tillroll.sources.files import (  # noqa: F401
    flatten_arrays,
    load_sales,
    profile,
    read_raw,
    read_rules_csv,
    read_sales,
    sample_rows,
    schema_table,
    write_rules_csv,
    write_sales,
)
