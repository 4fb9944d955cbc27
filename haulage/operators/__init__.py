"""DataFrame -> DataFrame operators, grouped by pipeline layer."""
