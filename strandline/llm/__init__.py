"""Operators for preparing training text: nothing else in the library imports this
package.  Each module holds one operator with a general interface; ``queries`` derives
the registered results from them and ``oracle`` holds their DuckDB SQL."""
