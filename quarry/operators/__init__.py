"""Operators: functions ``op(DataFrame, ...) -> DataFrame`` built from DataFrame / SQL / ML primitives."""
