"""Column-level functions: naming, masks, bands, dates, nested data, NULLs, UDF forms."""
