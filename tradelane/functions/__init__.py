"""Pure Column rules: no joins, no UDFs, everything stays in generated JVM code."""
