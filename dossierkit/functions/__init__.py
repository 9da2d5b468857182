"""Scalar expressions: Spark SQL text in, Spark SQL text out.

``df.selectExpr(f"{clean_numeric('price')} AS price")`` or ``F.expr(clean_numeric("price"))``. The
argument is a column name or any expression. As text, an expression costs one parse; the same tree
made of Column calls costs thousands of calls from Python to the JVM. All of it stays in the JVM.
"""
