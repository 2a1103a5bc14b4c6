"""Column expressions; all JVM-side, none needs Python workers."""
