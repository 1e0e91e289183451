"""Column-expression builders (JVM-side, codegen-friendly) and name helpers."""
