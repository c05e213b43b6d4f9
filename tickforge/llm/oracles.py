"""DuckDB SQL of the queries that SQL can express."""

from tickforge.llm import chat, lexical

SQL = {"op1_chat_format": chat.SQL, "op13_lexical": lexical.SQL}
