from article_warehouse.sources.articles import FrameSource, article_source
from article_warehouse.sources.documents import articles_from_documents
from article_warehouse.sources.jdbc import JdbcSource

__all__ = ["FrameSource", "JdbcSource", "article_source", "articles_from_documents"]
