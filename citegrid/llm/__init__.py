"""Training-data operators (text tables to tokens): see the README's section on ``llm``."""
