"""Column-expression helpers: everything here stays JVM-side (codegen)."""
