"""What the queries over small inputs are expected to give: group, item and value (JSON)."""

EXPECTED: dict[str, list[tuple[str, str, str]]] = {
    "fx_file_names": [
        ('0', 'before', '{}'),
        ('0', 'file_class', '{"v":"hard"}'),
        ('0', 'month', '{}'),
        ('0', 'plain', '{"v":"main.tex"}'),
        ('0', 'suffixed', '{"v":"main.tex"}'),
        ('1', 'before', '{}'),
        ('1', 'file_class', '{"v":"hard"}'),
        ('1', 'month', '{}'),
        ('1', 'plain', '{"v":"a.TEX"}'),
        ('1', 'suffixed', '{"v":"a.TEX.tex"}'),
        ('10', 'before', '{}'),
        ('10', 'file_class', '{"v":"other"}'),
        ('10', 'month', '{}'),
        ('10', 'plain', '{}'),
        ('10', 'suffixed', '{}'),
        ('2', 'before', '{}'),
        ('2', 'file_class', '{"v":"soft"}'),
        ('2', 'month', '{}'),
        ('2', 'plain', '{"v":"README"}'),
        ('2', 'suffixed', '{"v":"README.tex"}'),
        ('3', 'before', '{}'),
        ('3', 'file_class', '{"v":"component"}'),
        ('3', 'month', '{}'),
        ('3', 'plain', '{"v":"s.sty"}'),
        ('3', 'suffixed', '{"v":"s.sty.tex"}'),
        ('4', 'before', '{}'),
        ('4', 'file_class', '{"v":"component"}'),
        ('4', 'month', '{}'),
        ('4', 'plain', '{"v":"b.bbl"}'),
        ('4', 'suffixed', '{"v":"b.bbl.tex"}'),
        ('5', 'before', '{}'),
        ('5', 'file_class', '{"v":"other"}'),
        ('5', 'month', '{}'),
        ('5', 'plain', '{"v":"p.pdf"}'),
        ('5', 'suffixed', '{"v":"p.pdf.tex"}'),
        ('6', 'before', '{}'),
        ('6', 'file_class', '{"v":"hard"}'),
        ('6', 'month', '{}'),
        ('6', 'plain', '{"v":"x.tex"}'),
        ('6', 'suffixed', '{"v":"x.clean.tex"}'),
        ('7', 'before', '{}'),
        ('7', 'file_class', '{"v":"hard"}'),
        ('7', 'month', '{}'),
        ('7', 'plain', '{"v":"x.tex"}'),
        ('7', 'suffixed', '{"v":"x.revtex.tex"}'),
        ('8', 'before', '{"v":"/d"}'),
        ('8', 'file_class', '{"v":"soft"}'),
        ('8', 'month', '{}'),
        ('8', 'plain', '{"v":"/d/analysis.log/x"}'),
        ('8', 'suffixed', '{"v":"/d/analysis.log/x.tex"}'),
        ('9', 'before', '{}'),
        ('9', 'file_class', '{"v":"other"}'),
        ('9', 'month', '{"v":"1512"}'),
        ('9', 'plain', '{"v":"1512.03385"}'),
        ('9', 'suffixed', '{"v":"1512.03385.tex"}'),
    ],
    "fx_tex_sources": [
        ('0', 'bibliographies', '{"v":[]}'),
        ('0', 'cited', '{"v":[]}'),
        ('0', 'drawing', '{"v":"NoTIKZ"}'),
        ('0', 'klass', '{"v":{"options":[""],"name":""}}'),
        ('0', 'renamed', '{"v":"a % c\\n% whole\\nb \\\\% d"}'),
        ('0', 'repointed', '{"v":"a % c\\n% whole\\nb \\\\% d"}'),
        ('0', 'uncommented', '{"v":"a \\nb \\\\% d"}'),
        ('1', 'bibliographies', '{"v":[]}'),
        ('1', 'cited', '{"v":[]}'),
        ('1', 'drawing', '{"v":"HasTIKZ"}'),
        ('1', 'klass', '{"v":{"options":[""],"name":""}}'),
        ('1', 'renamed', '{"v":"\\\\usepackage{tikz-cd}"}'),
        ('1', 'repointed', '{"v":"\\\\usepackage{tikz-cd}"}'),
        ('1', 'uncommented', '{"v":"\\\\usepackage{tikz-cd}"}'),
        ('2', 'bibliographies', '{"v":[]}'),
        ('2', 'cited', '{"v":[]}'),
        ('2', 'drawing', '{"v":"NoTIKZ"}'),
        ('2', 'klass', '{"v":{"options":[""],"name":""}}'),
        ('2', 'renamed', '{"v":"\\\\usepackage{tikz}\\\\begin{picture}\\\\end{picture}"}'),
        ('2', 'repointed', '{"v":"\\\\usepackage{tikz}\\\\begin{picture}\\\\end{picture}"}'),
        ('2', 'uncommented', '{"v":"\\\\usepackage{tikz}\\\\begin{picture}\\\\end{picture}"}'),
        ('3', 'bibliographies', '{"v":[]}'),
        ('3', 'cited', '{"v":[]}'),
        ('3', 'drawing', '{"v":"HasTIKZ"}'),
        ('3', 'klass', '{"v":{"options":[""],"name":""}}'),
        ('3', 'renamed', '{"v":"\\\\usepackage{tikzit}"}'),
        ('3', 'repointed', '{"v":"\\\\usepackage{tikzit}"}'),
        ('3', 'uncommented', '{"v":"\\\\usepackage{tikzit}"}'),
        ('4', 'bibliographies', '{"v":[]}'),
        ('4', 'cited', '{"v":[]}'),
        ('4', 'drawing', '{"v":"NoTIKZ"}'),
        ('4', 'klass', '{"v":{"options":[""],"name":""}}'),
        ('4', 'renamed', '{"v":"\\\\usepackage[x]{amssymb}"}'),
        ('4', 'repointed', '{"v":"\\\\usepackage[x]{amssym}"}'),
        ('4', 'uncommented', '{"v":"\\\\usepackage[x]{amssym}"}'),
        ('5', 'bibliographies', '{"v":[]}'),
        ('5', 'cited', '{"v":[]}'),
        ('5', 'drawing', '{"v":"NoTIKZ"}'),
        ('5', 'klass', '{"v":{"options":["11pt","twocolumn"],"name":"article"}}'),
        ('5', 'renamed', '{"v":"\\\\documentclass[11pt, twocolumn]{article}"}'),
        ('5', 'repointed', '{"v":"\\\\documentclass[11pt, twocolumn]{article}"}'),
        ('5', 'uncommented', '{"v":"\\\\documentclass[11pt, twocolumn]{article}"}'),
        ('6', 'bibliographies', '{"v":["refs","more"]}'),
        ('6', 'cited', '{"v":["a","b","c"]}'),
        ('6', 'drawing', '{"v":"NoTIKZ"}'),
        ('6', 'klass', '{"v":{"options":[""],"name":""}}'),
        ('6', 'renamed', '{"v":"\\\\bibliography{refs, more}\\n\\\\cite{a,b}\\\\citep[see][]{c}"}'),
        ('6', 'repointed', '{"v":"\\\\bibliography{root}\\n\\\\cite{a,b}\\\\citep[see][]{c}"}'),
        ('6', 'uncommented', '{"v":"\\\\bibliography{refs, more}\\n\\\\cite{a,b}\\\\citep[see][]{c}"}'),
        ('7', 'bibliographies', '{"v":[]}'),
        ('7', 'cited', '{"v":[]}'),
        ('7', 'drawing', '{"v":"NoTIKZ"}'),
        ('7', 'klass', '{"v":{"options":[""],"name":""}}'),
        ('7', 'renamed', '{"v":"x\\n\\\\end{document}"}'),
        ('7', 'repointed', '{"v":"x\\n\\\\bibliography{root}\\n\\\\end{document}"}'),
        ('7', 'uncommented', '{"v":"x\\n\\\\end{document}"}'),
        ('8', 'bibliographies', '{}'),
        ('8', 'cited', '{}'),
        ('8', 'drawing', '{"v":"NoSource"}'),
        ('8', 'klass', '{"v":{}}'),
        ('8', 'renamed', '{}'),
        ('8', 'repointed', '{}'),
        ('8', 'uncommented', '{}'),
    ],
    "fx_tex_modes": [
        ('', 'extracted', '{"v":"\\\\odd[x]{y{z}}"}'),
        ('', 'kept', '{"v":"\\\\title{a}\\n\\\\newcommand{\\\\q}[1]{w}"}'),
        ('clean', 'removed', '{"v":[]}'),
        ('clean', 'text', '{"v":"\\\\documentclass{x}\\n\\\\usepackage{biblatex,amsmath}\\n%\\\\author{Me}\\n\\n\\\\newcommand{\\\\q}[1]{w{#1}}\\n\\\\DeclareMathOperator{\\\\op}{op}\\n\\\\addbibresource{refs.bib}\\n\\\\begin{document}\\n%\\\\affiliation{There}\\n\\n\\\\section{One} \\n%\\\\begin{figure}\\\\includegraphics{f}\\\\caption{C}\\\\label{l}\\\\end{figure}\\n\\\\caption{C}\\n\\\\label{l}\\n\\\\printbibliography\\n\\\\end{document}"}'),
        ('clean_beta', 'removed', '{"v":["biblatex"]}'),
        ('clean_beta', 'text', '{"v":"% \\\\documentclass{x}\\n\\\\documentclass[amsmath,amssymb,color,hyperref,cite]{revtex4-1}\\n\\\\usepackage{amsmath}\\n%\\\\author{Me}\\n\\n\\\\newcommand{\\\\q}[1]{w{#1}}\\n\\\\DeclareMathOperator{\\\\op}{op}\\n\\n\\\\begin{document}\\n%\\\\affiliation{There}\\n\\n\\\\section{One} \\n%\\\\begin{figure}\\\\includegraphics{f}\\\\caption{C}\\\\label{l}\\\\end{figure}\\n\\\\caption{C}\\n\\\\label{l}\\n\\n\\\\bibliography{refs}\\n\\\\end{document}"}'),
        ('nopackage', 'removed', '{"v":[]}'),
        ('nopackage', 'text', '{"v":"% \\\\documentclass{x}\\n\\\\documentclass[amsmath,amssymb,color,hyperref,cite]{revtex4-1}\\n% \\\\usepackage{biblatex,amsmath}\\n%\\\\author{Me}\\n\\n\\\\newcommand{\\\\q}[1]{w{#1}}\\n\\\\DeclareMathOperator{\\\\op}{op}\\n\\n\\\\begin{document}\\n%\\\\affiliation{There}\\n\\n\\\\section{One} \\n%\\\\begin{figure}\\\\includegraphics{f}\\\\caption{C}\\\\label{l}\\\\end{figure}\\n\\\\caption{C}\\n\\\\label{l}\\n\\n\\\\bibliography{refs}\\n\\\\end{document}"}'),
        ('revtex', 'removed', '{"v":[]}'),
        ('revtex', 'text', '{"v":"% \\\\documentclass{x}\\n\\\\documentclass[amsmath,amssymb,color,hyperref,cite]{revtex4-1}\\n\\\\usepackage{biblatex,amsmath}\\n%\\\\author{Me}\\n\\n\\\\newcommand{\\\\q}[1]{w{#1}}\\n\\\\DeclareMathOperator{\\\\op}{op}\\n\\n\\\\begin{document}\\n%\\\\affiliation{There}\\n\\n\\\\section{One} \\n%\\\\begin{figure}\\\\includegraphics{f}\\\\caption{C}\\\\label{l}\\\\end{figure}\\n\\\\caption{C}\\n\\\\label{l}\\n\\n\\\\bibliography{refs}\\n\\\\end{document}"}'),
        ('revtex_beta', 'removed', '{"v":[]}'),
        ('revtex_beta', 'text', '{"v":"% \\\\documentclass{x}\\n\\\\documentclass[amsmath,amssymb,color,hyperref,cite]{revtex4-1}\\n\\\\usepackage{biblatex,amsmath}\\n%\\\\author{Me}\\n\\n\\\\newcommand{\\\\q}[1]{w{#1}}\\n\\\\DeclareMathOperator{\\\\op}{op}\\n\\n\\\\begin{document}\\n%\\\\affiliation{There}\\n\\n\\\\section{One} \\n%\\\\begin{figure}\\\\includegraphics{f}\\\\caption{C}\\\\label{l}\\\\end{figure}\\n\\\\caption{C}\\n\\\\label{l}\\n\\n\\\\bibliography{refs}\\n\\\\end{document}"}'),
    ],
    "fx_projects": [
        ('a', 'bucket', '{"v":{"bucket":"remake","root":"main.tex"}}'),
        ('a', 'cleaned', '{"v":{"has_tex":true,"names":["main.tex","sec.tex"]}}'),
        ('a', 'folder', '{"v":"isTeX"}'),
        ('a', 'good', '{"v":{"status":"good","names":["main.tex","sec.tex"]}}'),
        ('a', 'main', '{"v":"sec"}'),
        ('a', 'root', '{"v":{"status":"root_file","root":"main.tex"}}'),
        ('b', 'bucket', '{"v":{"bucket":"multi"}}'),
        ('b', 'cleaned', '{"v":{"has_tex":true,"names":["x.bbl","x.tex","y.tex"]}}'),
        ('b', 'folder', '{"v":"isTeX"}'),
        ('b', 'good', '{"v":{"status":"good","names":["x.tex","y.tex"]}}'),
        ('b', 'root', '{"v":{"status":"root_file","root":"x.tex"}}'),
        ('c', 'bucket', '{"v":{"bucket":"remake","root":"only.tex"}}'),
        ('c', 'cleaned', '{"v":{"has_tex":true,"names":["only.tex"]}}'),
        ('c', 'folder', '{"v":"isTeX"}'),
        ('c', 'good', '{"v":{"status":"good","names":["only.tex"]}}'),
        ('c', 'root', '{"v":{"status":"root_file","root":"only.tex"}}'),
        ('d', 'bucket', '{"v":{"bucket":"missing"}}'),
        ('d', 'cleaned', '{"v":{"has_tex":false}}'),
        ('d', 'folder', '{"v":"NoTeX"}'),
        ('d', 'good', '{"v":{"status":"none","names":[]}}'),
        ('d', 'root', '{"v":{"status":"no_tex"}}'),
        ('e', 'bucket', '{"v":{"bucket":"missing"}}'),
        ('e', 'cleaned', '{"v":{"has_tex":true,"names":["p.tex","q.tex"]}}'),
        ('e', 'folder', '{"v":"isTeX"}'),
        ('e', 'good', '{"v":{"status":"good","names":["p.tex","q.tex"]}}'),
        ('e', 'root', '{"v":{"status":"multifiles_case"}}'),
        ('f', 'bucket', '{"v":{"bucket":"multi"}}'),
        ('f', 'cleaned', '{"v":{"has_tex":true,"names":["one.tex","supplement.tex"]}}'),
        ('f', 'folder', '{"v":"isTeX"}'),
        ('f', 'good', '{"v":{"status":"good","names":["one.tex","supplement.tex"]}}'),
        ('f', 'root', '{"v":{"status":"root_file","root":"one.tex"}}'),
        ('g', 'bucket', '{"v":{"bucket":"remake","root":"z.clean.tex"}}'),
        ('g', 'cleaned', '{"v":{"has_tex":true,"names":["z.clean.tex"]}}'),
        ('g', 'folder', '{"v":"isTeX"}'),
        ('g', 'good', '{"v":{"status":"renamed","names":["z.tex"]}}'),
        ('g', 'root', '{"v":{"status":"root_file","root":"z.clean.tex"}}'),
        ('h', 'bucket', '{"v":{"bucket":"missing"}}'),
        ('h', 'cleaned', '{"v":{"has_tex":true,"names":["w.revtex.tex","z.clean.tex"]}}'),
        ('h', 'folder', '{"v":"isTeX"}'),
        ('h', 'good', '{"v":{"status":"ErrorCaseI","names":[]}}'),
        ('h', 'root', '{"v":{"status":"multifiles_case"}}'),
        ('i', 'bucket', '{"v":{"bucket":"remake","root":"U.TEX"}}'),
        ('i', 'cleaned', '{"v":{"has_tex":true,"names":["U.tex"]}}'),
        ('i', 'folder', '{"v":"isTeX"}'),
        ('i', 'good', '{"v":{"status":"good","names":["U.TEX"]}}'),
        ('i', 'root', '{"v":{"status":"root_file","root":"U.TEX"}}'),
        ('j', 'bucket', '{"v":{"bucket":"missing"}}'),
        ('j', 'cleaned', '{"v":{"has_tex":false,"names":["readme"]}}'),
        ('j', 'folder', '{"v":"isPlainTeX"}'),
        ('j', 'good', '{"v":{"status":"none","names":[]}}'),
        ('j', 'root', '{"v":{"status":"root_file","root":"readme"}}'),
        ('listing', 'quant-ph/a.tex', '{"v":true}'),
        ('listing', 'quant-ph/c.BIB', '{"v":true}'),
    ],
    "fx_logs": [
        ('0', 'counts', '{"v":{"warnings":2,"errors":1,"macros":3,"missing":1}}'),
        ('0', 'missing', '{"v":["foo.sty"]}'),
        ('1', 'counts', '{"v":{"warnings":0,"errors":0,"macros":0,"missing":0}}'),
        ('1', 'missing', '{"v":[]}'),
        ('2', 'counts', '{"v":{"warnings":4,"errors":0,"macros":0,"missing":0}}'),
        ('2', 'missing', '{"v":[]}'),
        ('3', 'counts', '{"v":{"warnings":0,"errors":0,"macros":0,"missing":0}}'),
        ('3', 'missing', '{"v":["my.cls"]}'),
        ('4', 'counts', '{"v":{"warnings":0,"errors":0,"macros":0,"missing":0}}'),
        ('4', 'missing', '{"v":[]}'),
        ('foo.sty', 'true', '{"v":1}'),
        ('p', 'clean', '{"v":"Error"}'),
        ('p', 'clean/0', '{"v":false}'),
        ('p', 'clean/1', '{"v":false}'),
        ('p', 'clean/2', '{"v":true}'),
        ('p', 'passed', '{"v":true}'),
        ('p', 'place', '{"v":"done"}'),
        ('p', 'revtex', '{"v":"Success"}'),
        ('p', 'revtex/0', '{"v":false}'),
        ('q', 'clean', '{"v":"Warning"}'),
        ('q', 'clean/0', '{"v":false}'),
        ('q', 'passed', '{"v":true}'),
        ('q', 'place', '{"v":"without_bibliography"}'),
        ('r', 'clean', '{"v":"EmptyLog"}'),
        ('r', 'clean/0', '{"v":false}'),
        ('r', 'passed', '{"v":false}'),
        ('r', 'place', '{"v":"unprocessed"}'),
    ],
    "fx_bibliographies": [
        ('0', 'item', '{"v":{"label":"Ab(20)","key":"k1","content":"A. Bee, \\\\emph{On {\\\\bf drifts}}."}}'),
        ('0', 'plain', '{"v":"A. Bee, On drifts ."}'),
        ('1', 'item', '{"v":{"key":"k2","content":"\\\\newblock C~D"}}'),
        ('1', 'plain', '{"v":"C D"}'),
        ('a', 'merged', '{"v":"x BBL y"}'),
        ('a', 'ready', '{"v":"pass"}'),
        ('a', 'triage', '{"v":"noref_but_bbl"}'),
        ('b', 'merged', '{"v":"zBBL\\n\\\\end{document}"}'),
        ('b', 'ready', '{"v":"empty_reference"}'),
        ('b', 'triage', '{"v":"noref_but_bib"}'),
        ('c', 'merged', '{"v":"w"}'),
        ('c', 'ready', '{"v":"no_reference"}'),
        ('c', 'triage', '{"v":"noref_no_cite"}'),
        ('d', 'triage', '{"v":"noref_other_bib"}'),
        ('e', 'triage', '{"v":"ref_bbl_complete"}'),
        ('f', 'triage', '{"v":"ref_part_bbl"}'),
        ('g', 'triage', '{"v":"ref_only_bib"}'),
        ('h', 'triage', '{"v":"ref_incomplete_bbl"}'),
        ('i', 'triage', '{"v":"ref_incomplete_bib"}'),
        ('j', 'triage', '{"v":"ref_no_bib"}'),
        ('k', 'triage', '{"v":"ref_bbl_complete"}'),
    ],
    "fx_xml": [
        ('block', '00', '{"v":{"path":[0],"level":1,"title":"Start","kind":"heading","text":"Start"}}'),
        ('block', '01', '{"v":{"path":[0],"level":1,"title":"Start","kind":"text","text":"As in [Ref.0 of P] and Fig. [Figure.2 of P], see [Ref.MissingCite_0 of P] it."}}'),
        ('block', '02', '{"v":{"path":[0],"level":1,"title":"Start","kind":"text","text":"Noted (Note: A remark, as in the work of Dee and others.) here."}}'),
        ('block', '03', '{"v":{"path":[0],"level":1,"title":"Start","kind":"text","text":"$$ c=d $$\\n![Figure:F1]"}}'),
        ('block', '04', '{"v":{"path":[1],"level":1,"title":"End","kind":"heading","text":"End"}}'),
        ('block', '05', '{"v":{"path":[1],"level":1,"title":"End","kind":"text","text":"![Table:T1]"}}'),
        ('block', '06', '{"v":{"path":[1],"level":1,"title":"End","kind":"item","text":"one"}}'),
        ('block', '07', '{"v":{"path":[1],"level":1,"title":"End","kind":"item","text":"**two**"}}'),
        ('block', '08', '{"v":{"path":[2],"level":1,"title":"More","kind":"heading","text":"More"}}'),
        ('block', '09', '{"v":{"path":[2],"level":1,"title":"More","kind":"text","text":"Aside."}}'),
        ('block', '10', '{"v":{"path":[],"level":0,"kind":"note","text":"Foot."}}'),
        ('cited', 'F1', '{"v":1}'),
        ('cited', 'k1', '{"v":1}'),
        ('cited', 'k3', '{"v":1}'),
        ('label', 'E1', '{"v":{"type":"Equation","label":"3"}}'),
        ('label', 'F1', '{"v":{"type":"Figure","label":"2"}}'),
        ('label', 'LABEL:s1', '{"v":{"type":"Section","label":"1"}}'),
        ('label', 'S1', '{"v":{"type":"Section","label":"1"}}'),
        ('label', 'T1', '{"v":{"type":"Table","label":"7"}}'),
        ('label', 'k1', '{"v":{"type":"Reference","label":"0"}}'),
        ('label', 'k2', '{"v":{"type":"Reference","label":"1"}}'),
        ('markdown', 'P', '{"v":"# Abstract\\n\\nWe show $a b$ .\\n\\n## Start\\n\\nAs in [Ref.0 of P] and Fig. [Figure.2 of P], see [Ref.MissingCite_0 of P] it.\\n\\nNoted (Note: A remark, as in the work of Dee and others.) here.\\n\\n$$ c=d $$\\n![](f.png)\\n\\n## End\\n\\n| x | y |\\n| --- | --- |\\n| 1 | 2 |\\n\\n- one\\n\\n- **two**\\n\\n## More\\n\\nAside.\\n\\n> Foot."}'),
        ('media', 'F1', '{"v":{"kind":"Figure","caption":"A figure","source":"![](f.png)"}}'),
        ('media', 'T1', '{"v":{"kind":"Table","caption":"Tab","source":"| x | y |\\n| --- | --- |\\n| 1 | 2 |"}}'),
        ('missing', 'k3', '{"v":0}'),
        ('paper', 'head', '{"v":{"status":"Finish","title":"On drifts","abstract":"We show $a b$ .","author":["A. Bee"],"missing":["k3"]}}'),
        ('reference', 'k1', '{"v":{"pos":0,"text":"C. Dee, 2001.","is_note":false,"in_context":true}}'),
        ('reference', 'k2', '{"v":{"pos":1,"text":"A remark, as in the work of Dee and others.","is_note":true,"in_context":false}}'),
    ],
    "fx_html": [
        ('block', '00', '{"v":{"path":[0],"level":1,"title":"Start","kind":"heading","text":"Start"}}'),
        ('block', '01', '{"v":{"path":[0],"level":1,"title":"Start","kind":"text","text":"Shown in [Ref.0 of P] by $x^{2}$ ."}}'),
        ('block', '02', '{"v":{"path":[0],"level":1,"title":"Start","kind":"text","text":"![Figure:F1]\\n![Table:table_1]"}}'),
        ('cited', 'b1', '{"v":1}'),
        ('label', 'F1', '{"v":{"type":"Figure","label":"4"}}'),
        ('label', 'S1', '{"v":{"type":"Section","label":"1"}}'),
        ('label', 'b1', '{"v":{"type":"Reference","label":"0"}}'),
        ('label', 'table_1', '{"v":{"type":"Table","label":"1"}}'),
        ('markdown', 'P', '{"v":"# Abstract\\n\\nShort.\\n\\n## Start\\n\\nShown in [Ref.0 of P] by $x^{2}$ .\\n\\n![](f.png)\\n| plain |\\n| --- |"}'),
        ('media', 'F1', '{"v":{"kind":"Figure","caption":"A figure","source":"![](f.png)"}}'),
        ('media', 'table_1', '{"v":{"kind":"Table","caption":"","source":"| plain |\\n| --- |"}}'),
        ('paper', 'head', '{"v":{"status":"Finish","title":"On drifts","abstract":"Short.","author":[],"missing":[]}}'),
        ('reference', 'b1', '{"v":{"pos":0,"text":"C. Dee, 2001.","is_note":false,"in_context":true}}'),
    ],
    "fx_xml_states": [
        ('broken', 'html', '{"v":"NoArticle"}'),
        ('broken', 'xml', '{"v":"Finish"}'),
        ('none', 'html', '{"v":"NoHTML"}'),
        ('none', 'xml', '{"v":"NoXML"}'),
        ('small', 'html', '{"v":"TooSmall"}'),
        ('small', 'xml', '{"v":"TooSmall"}'),
        ('text', 'html', '{"v":"NoArticle"}'),
        ('text', 'xml', '{"v":"ParseError"}'),
        ('whole', 'html', '{"v":"NoArticle"}'),
        ('whole', 'xml', '{"v":"Finish"}'),
    ],
    "fx_classic": [
        ('', 'counts', '{"v":"{\'a\': [(\'Figure\', \'0\')], \'b\': [(\'Figure\', \'1\')]}"}'),
        ('', 'labels', '{"v":"{\'a\': [(\'Figure\', \'1\'), (\'Table\', \'7\')], \'b\': [(\'Figure\', \'2\')]}"}'),
        ('', 'unique', '{"v":"<a id=\\"x\\"><b id=\\"x_1\\" /><c id=\\"x_2\\" /><d id=\\"y\\" /></a>"}'),
        ('paper', 'rest', '{"v":{"status":"Finish","appendix":[{"title":"More","paragraph":["Aside."]}],"index":[],"put_back":["k2"]}}'),
        ('section', '0', '{"v":{"tag":"1","section_title":"Start","section_content":[["As in [Ref.0 of P] and Fig. [Figure.2 of P], see [Ref.MissingCite_0 of P] it."],["Noted (Note: A remark, as in the work of Dee and others.) here.[[[Notice: Foot.]]]"],["$$ c=d $$\\n![Figure:F1]"]]}}'),
        ('section', '1', '{"v":{"tag":"","section_title":"End","section_content":[["![Table:T1]"],["one"],["**two**"]]}}'),
    ],
    "fx_text": [
        ('', 'merged', '{"v":"@a{k,\\n author = {A B, C D},\\n year = 1}"}'),
        ('', 'once', '{"v":"so [Ref.1 of P, Ref.2 of P] is"}'),
        ('0', 'arxiv', '{}'),
        ('0', 'brackets', '{"v":" a \u2003 b\\n c "}'),
        ('0', 'last', '{"v":8}'),
        ('0', 'lines', '{"v":"a b\\nc"}'),
        ('0', 'names', '{"v":"We show [1, 2] it. [3] holds"}'),
        ('0', 'normal', '{"v":"a b c"}'),
        ('0', 'note', '{"v":false}'),
        ('0', 'number', '{}'),
        ('0', 'numbers', '{"v":"We show (See [Ref.1, 2 of P]) it. [Ref.3 of P] holds"}'),
        ('0', 'people', '{"v":[]}'),
        ('0', 'single', '{"v":"a b c"}'),
        ('0', 'tokens', '{"v":3}'),
        ('0', 'year', '{"v":false}'),
        ('1', 'arxiv', '{}'),
        ('1', 'brackets', '{"v":"\\\\displaystyle x  y\\n\\n z"}'),
        ('1', 'last', '{"v":21}'),
        ('1', 'lines', '{"v":"x y\\nz"}'),
        ('1', 'names', '{"v":"as in [4]"}'),
        ('1', 'normal', '{"v":"\\\\displaystyle x y z"}'),
        ('1', 'note', '{"v":false}'),
        ('1', 'number', '{}'),
        ('1', 'numbers', '{"v":"as in [Ref.4 of P]"}'),
        ('1', 'people', '{"v":[]}'),
        ('1', 'single', '{"v":"\\\\displaystyle x y z"}'),
        ('1', 'tokens', '{"v":4}'),
        ('1', 'year', '{"v":false}'),
        ('2', 'arxiv', '{}'),
        ('2', 'brackets', '{"v":"Smith 2001"}'),
        ('2', 'last', '{"v":4}'),
        ('2', 'lines', '{"v":"Smith 2001"}'),
        ('2', 'names', '{"v":"end. [Ref.2 of ArXiv:x] so"}'),
        ('2', 'normal', '{"v":"smith 2001"}'),
        ('2', 'note', '{"v":false}'),
        ('2', 'number', '{"v":2001}'),
        ('2', 'numbers', '{"v":"end. [Ref.2 of ArXiv:x] so"}'),
        ('2', 'people', '{"v":[]}'),
        ('2', 'single', '{"v":"Smith 2001"}'),
        ('2', 'tokens', '{"v":9}'),
        ('2', 'year', '{"v":true}'),
        ('3', 'arxiv', '{}'),
        ('3', 'brackets', '{"v":"one two three four five six seven eight nine ten"}'),
        ('3', 'last', '{"v":47}'),
        ('3', 'lines', '{"v":"one two three four five six seven eight nine ten"}'),
        ('3', 'names', '{"v":"we (See [DOI:10/a]) x"}'),
        ('3', 'normal', '{"v":"one two three four five six seven eight nine ten"}'),
        ('3', 'note', '{"v":true}'),
        ('3', 'number', '{}'),
        ('3', 'numbers', '{"v":"we [DOI:10/a] x"}'),
        ('3', 'people', '{"v":[]}'),
        ('3', 'single', '{"v":"one two three four five six seven eight nine ten"}'),
        ('3', 'tokens', '{"v":39}'),
        ('3', 'year', '{"v":false}'),
        ('4', 'arxiv', '{"v":"2101.12345v2"}'),
        ('4', 'brackets', '{"v":"arXiv: 2101.12345v2 x"}'),
        ('4', 'last', '{"v":20}'),
        ('4', 'lines', '{"v":"arXiv: 2101.12345v2 x"}'),
        ('4', 'normal', '{"v":"arxiv: 2101.12345v2 x"}'),
        ('4', 'note', '{"v":false}'),
        ('4', 'number', '{"v":2101}'),
        ('4', 'people', '{"v":[]}'),
        ('4', 'single', '{"v":"arXiv: 2101.12345v2 x"}'),
        ('4', 'tokens', '{"v":18}'),
        ('4', 'year', '{"v":false}'),
        ('5', 'arxiv', '{}'),
        ('5', 'brackets', '{"v":"J. Bee and K. L. Cee"}'),
        ('5', 'last', '{"v":19}'),
        ('5', 'lines', '{"v":"J. Bee and K. L. Cee"}'),
        ('5', 'normal', '{"v":"j. bee and k. l. cee"}'),
        ('5', 'note', '{"v":false}'),
        ('5', 'number', '{}'),
        ('5', 'people', '{"v":["J. Bee","K. L. Cee"]}'),
        ('5', 'single', '{"v":"J. Bee and K. L. Cee"}'),
        ('5', 'tokens', '{"v":15}'),
        ('5', 'year', '{"v":false}'),
        ('6', 'arxiv', '{}'),
        ('6', 'brackets', '{"v":"[a] [b]"}'),
        ('6', 'last', '{"v":7}'),
        ('6', 'lines', '{"v":"[[a]] [b]"}'),
        ('6', 'normal', '{"v":"[[a]] [b]"}'),
        ('6', 'note', '{"v":false}'),
        ('6', 'number', '{}'),
        ('6', 'people', '{"v":[]}'),
        ('6', 'single', '{"v":"[[a]] [b]"}'),
        ('6', 'tokens', '{"v":2}'),
        ('6', 'year', '{"v":false}'),
        ('7', 'arxiv', '{}'),
        ('7', 'brackets', '{}'),
        ('7', 'last', '{}'),
        ('7', 'lines', '{}'),
        ('7', 'normal', '{}'),
        ('7', 'note', '{}'),
        ('7', 'number', '{}'),
        ('7', 'people', '{}'),
        ('7', 'single', '{}'),
        ('7', 'tokens', '{}'),
        ('7', 'year', '{}'),
        ('bare', '(', '{"v":{"left":"","right":""}}'),
        ('bare', 'It holds.', '{"v":{"left":"It holds.","right":""}}'),
        ('bare', 'as refs', '{"v":{"left":"as refs","right":"x"}}'),
        ('bare', 'see Fig.', '{"v":{"left":"see Fig.","right":"x"}}'),
        ('bare', 'shown and', '{"v":{"left":"shown and","right":"Next"}}'),
        ('bare', 'shown in', '{"v":{"left":"shown in","right":"r"}}'),
        ('bare', 'we find', '{"v":{"left":"we find","right":"that"}}'),
        ('cited', '(', '{"v":"(See [Ref.3 of P])"}'),
        ('cited', 'It holds.', '{"v":"[Ref.3 of P]."}'),
        ('cited', 'as refs', '{"v":"(See [Ref.3 of P])"}'),
        ('cited', 'see Fig.', '{"v":"[Ref.3 of P]"}'),
        ('cited', 'shown and', '{"v":"[Ref.3 of P]."}'),
        ('cited', 'shown in', '{"v":"[Ref.3 of P]"}'),
        ('cited', 'we find', '{"v":"(See [Ref.3 of P])"}'),
        ('ids', '(', '{"v":"(See [a,b])"}'),
        ('ids', 'It holds.', '{"v":"[a,b]"}'),
        ('ids', 'as refs', '{"v":"(See [a,b])"}'),
        ('ids', 'see Fig.', '{"v":"[a,b]"}'),
        ('ids', 'shown and', '{"v":"[a,b]"}'),
        ('ids', 'shown in', '{"v":"[a,b]"}'),
        ('ids', 'we find', '{"v":"(See [a,b])"}'),
        ('named', '(', '{"v":{"left":"(","label":"3","hit":false}}'),
        ('named', 'It holds.', '{"v":{"left":"It holds.","label":"3","hit":false}}'),
        ('named', 'as refs', '{"v":{"left":"as  ","label":" [Ref.3 of P]","hit":true}}'),
        ('named', 'see Fig.', '{"v":{"left":"see ","label":" [Figure.3 of P]","hit":true}}'),
        ('named', 'shown and', '{"v":{"left":"shown and","label":"3","hit":false}}'),
        ('named', 'shown in', '{"v":{"left":"shown in","label":"3","hit":false}}'),
        ('named', 'we find', '{"v":{"left":"we find","label":"3","hit":false}}'),
    ],
    "fx_marks": [
        ('acknowledgement', '5', '{"v":{"section_num":"2","section_name":"End","text":"Acknowledgement of all"}}'),
        ('body', '0', '{"v":{"section_num":"1","section_name":"Intro","text":"We use [Ref.0 of ArXiv:X] and $x^2$"}}'),
        ('body', '1', '{"v":{"section_num":"1","section_name":"Intro","text":"so it goes on. [Ref.0 of ArXiv:X, Ref.2 of ArXiv:X]"}}'),
        ('body', '2', '{"v":{"section_num":"1","section_name":"Intro","text":"Next [Figure.0 of ArXiv:X] here $"}}'),
        ('body', '3', '{"v":{"section_num":"1","section_name":"Intro","text":"After it."}}'),
        ('body', '4', '{"v":{"section_num":"A-1","section_name":"Proofs","text":"Appendix text"}}'),
        ('cite', 'K1', '{"v":{"n":0,"value":"[Ref.0 of ArXiv:X]"}}'),
        ('cite', 'K2', '{"v":{"n":2,"value":"[Ref.2 of ArXiv:X]"}}'),
        ('cite', 'k1 ', '{"v":{"n":1,"value":"[Ref.1 of ArXiv:X]"}}'),
        ('figure', 'G1', '{"v":{"n":0,"value":"[Figure.0 of ArXiv:X]"}}'),
        ('formula', 'F1', '{"v":{"n":0,"value":"$x^2$"}}'),
        ('joined', '0', '{"v":{"section_num":"1","text":"We use [Ref.0 of ArXiv:X] and $x^2$ so it goes on. [Ref.0 of ArXiv:X, Ref.2 of ArXiv:X]"}}'),
        ('joined', '2', '{"v":{"section_num":"1","text":"Next [Figure.0 of ArXiv:X] here $ After it."}}'),
        ('joined', '4', '{"v":{"section_num":"A-1","text":"Appendix text"}}'),
        ('packed', '1/0', '{"v":{"text":"We use [Ref.0 of ArXiv:X] and $x^2$","n_words":7}}'),
        ('packed', '1/1', '{"v":{"text":"so it goes on. [Ref.0 of ArXiv:X, Ref.2 of ArXiv:X]","n_words":10}}'),
        ('packed', '1/2', '{"v":{"text":"Next [Figure.0 of ArXiv:X] here $\\nAfter it.","n_words":8}}'),
        ('packed', 'A-1/4', '{"v":{"text":"Appendix text","n_words":2}}'),
        ('reference', '6', '{"v":{"section_num":"3","section_name":"","text":"References follow"}}'),
        ('reference', '7', '{"v":{"section_num":"3","section_name":"","text":"Lost"}}'),
        ('resolved', 'K1', '{"v":true}'),
        ('resolved', 'K2', '{"v":false}'),
        ('resolved', 'k1 ', '{"v":false}'),
        ('section', '1', '{"v":{"section_title":"Intro","section_content":["We use [Ref.0 of ArXiv:X] and $x^2$ so it goes on. [Ref.0 of ArXiv:X, Ref.2 of ArXiv:X]","Next [Figure.0 of ArXiv:X] here $ After it."],"is_appendix":false}}'),
        ('section', 'A-1', '{"v":{"section_title":"Proofs","section_content":["Appendix text"],"is_appendix":true}}'),
        ('table', 'T1', '{"v":{"n":0,"value":"[Table.0 of ArXiv:X]"}}'),
    ],
    "fx_references": [
        ('', 'recommended', '{"v":{"mag":"m","doi":"b","arXiv":"c"}}'),
        ('0', 'author', '{"v":["J. M. Bee","C Dee","E Eff"]}'),
        ('0', 'content', '{}'),
        ('0', 'journal', '{"v":"J. Drift"}'),
        ('0', 'journal_page', '{"v":"12-15"}'),
        ('0', 'journal_volume', '{"v":"3"}'),
        ('0', 'keep', '{"v":true}'),
        ('0', 'publisher', '{}'),
        ('0', 'short', '{"v":"J. M. Bee"}'),
        ('0', 'title', '{"v":"On drifts of things"}'),
        ('0', 'unique_id', '{"v":{"doi":"10/x","pubmed":"7"}}'),
        ('0', 'year', '{"v":1999}'),
        ('1', 'author', '{"v":["L. van Beethoven","M. King","Plato"]}'),
        ('1', 'content', '{}'),
        ('1', 'journal', '{"v":"Ann. X"}'),
        ('1', 'journal_page', '{"v":"4"}'),
        ('1', 'journal_volume', '{"v":"9"}'),
        ('1', 'keep', '{"v":true}'),
        ('1', 'publisher', '{"v":"P"}'),
        ('1', 'short', '{"v":"J. M. Bee"}'),
        ('1', 'title', '{}'),
        ('1', 'unique_id', '{}'),
        ('1', 'year', '{"v":2001}'),
        ('2', 'author', '{"v":["M. Curie"]}'),
        ('2', 'content', '{}'),
        ('2', 'journal', '{"v":"Nature"}'),
        ('2', 'journal_page', '{"v":"2"}'),
        ('2', 'journal_volume', '{"v":"1"}'),
        ('2', 'keep', '{"v":true}'),
        ('2', 'publisher', '{}'),
        ('2', 'short', '{"v":"J. Bee"}'),
        ('2', 'title', '{}'),
        ('2', 'unique_id', '{"v":{"arxiv":"1234.5678","semopenalex":"w1"}}'),
        ('2', 'year', '{"v":2003}'),
        ('3', 'author', '{}'),
        ('3', 'content', '{}'),
        ('3', 'journal', '{}'),
        ('3', 'journal_page', '{}'),
        ('3', 'journal_volume', '{}'),
        ('3', 'keep', '{"v":false}'),
        ('3', 'publisher', '{}'),
        ('3', 'short', '{"v":"L. van Beethoven"}'),
        ('3', 'title', '{}'),
        ('3', 'unique_id', '{}'),
        ('3', 'year', '{}'),
        ('4', 'author', '{}'),
        ('4', 'content', '{}'),
        ('4', 'journal', '{}'),
        ('4', 'journal_page', '{}'),
        ('4', 'journal_volume', '{}'),
        ('4', 'keep', '{"v":false}'),
        ('4', 'publisher', '{}'),
        ('4', 'short', '{"v":"M. de la Cruz"}'),
        ('4', 'title', '{}'),
        ('4', 'unique_id', '{}'),
        ('4', 'year', '{}'),
        ('5', 'short', '{"v":"Plato"}'),
        ('6', 'short', '{"v":"A. B"}'),
        ('7', 'short', '{}'),
        ('a', 'same', '{"v":true}'),
        ('b', 'same', '{"v":false}'),
        ('c', 'same', '{"v":false}'),
        ('filled', '1', '{"v":{"title":"t","year":1,"changed":false}}'),
        ('filled', 'none', '{"v":{"title":"t","year":3,"changed":true}}'),
        ('flat', '0', '{"v":{"title":"On drifts of things","journal":"J. Drift","journal_volume":"3","journal_page":"12-15","year":1999,"author_0":"J. M. Bee","author_1":"C Dee","author_2":"E Eff"}}'),
    ],
    "fx_csl": [
        ('', 'bad', '{"v":false}'),
        ('', 'good', '{"v":true}'),
        ('', 'short', '{"v":"J. Bee, C. Dee, and E. Eff, J. X, vol. 3, pp. 12, 1999."}'),
        ('0', 'csl', '{"v":{"type":"Article","title":"On drifts of things","author":[{"given":"Jane Mary","family":"Bee"}],"container_title":"J. Drift","volume":"3","page":"12-15","issued":1999}}'),
        ('0', 'entry', '{"v":{"type":"article","key":"k1","author":[{"family":"Bee","given":"Jane"},{"family":"Dee","given":"C."}],"lacking":[]}}'),
        ('0', 'fields', '{"v":[{"key":"author","value":"Bee, Jane and C. Dee"},{"key":"journal","value":"J X"},{"key":"title","value":"On Drifts"},{"key":"year","value":"1999"}]}'),
        ('1', 'csl', '{"v":{"type":"Article","title":"A","container_title":"Ann. X","volume":"9","issued":2001}}'),
        ('1', 'entry', '{"v":{"type":"book","key":"k2","author":[],"lacking":[]}}'),
        ('1', 'fields', '{"v":[{"key":"address","value":"Q"},{"key":"editor","value":"E"},{"key":"publisher","value":"P, Q"},{"key":"title","value":"T"},{"key":"year","value":"2000"}]}'),
        ('2', 'csl', '{"v":{"type":"Book","author":[{"given":"","family":"Marie S. Curie"},{"given":"","family":"Plato"},{"given":"","family":"Group"}],"container_title":"N"}}'),
        ('2', 'entry', '{"v":{"type":"misc","key":"k3","author":[],"lacking":[]}}'),
        ('2', 'fields', '{"v":[]}'),
    ],
    "fx_identity": [
        ('AX', '1', '{"v":{"entity_id":"UA.SS.4","outcome":"known"}}'),
        ('AX', '2', '{"v":{"entity_id":"AX.2","outcome":"new"}}'),
        ('CR', '1', '{"v":{"entity_id":"CR.1","outcome":"new"}}'),
        ('CR', '4', '{"v":{"entity_id":"CR.4","outcome":"new"}}'),
        ('UA', '1/0', '{"v":{"entity_id":"UA.SS.4","outcome":"known"}}'),
        ('UA.SS', '1', '{"v":{"outcome":"conflict"}}'),
        ('UA.SS', '2', '{"v":{"outcome":"conflict"}}'),
        ('UA.SS', '3', '{"v":{"outcome":"conflict"}}'),
        ('UA.SS', '4', '{"v":{"entity_id":"UA.SS.4","outcome":"new"}}'),
        ('UA.SS', '5', '{"v":{"outcome":"no_ids"}}'),
        ('alias', 'arxiv:8', '{"v":"AX.2"}'),
        ('alias', 'arxiv:9', '{"v":"UA.SS.4"}'),
        ('alias', 'doi:10/a', '{"v":"CR.1"}'),
        ('alias', 'doi:10/c', '{"v":"CR.4"}'),
        ('alias', 'doi:10/z', '{"v":"AX.2"}'),
        ('alias', 'openalex:W5', '{"v":"UA.SS.4"}'),
        ('conflict', '1:doi', '{"v":"CR.1"}'),
        ('conflict', '2:doi', '{"v":"CR.1"}'),
        ('conflict', '3:doi', '{"v":"CR.4"}'),
        ('first', 'a', '{"v":"CR.4"}'),
        ('ids AX', '1', '{"v":[{"key":"arxiv","value":"9"}]}'),
        ('ids AX', '2', '{"v":[{"key":"arxiv","value":"8"},{"key":"doi","value":"10/z"}]}'),
        ('ids CR', '1', '{"v":[{"key":"doi","value":"10/a"}]}'),
        ('ids CR', '4', '{"v":[{"key":"doi","value":"10/c"}]}'),
        ('ids UA', '1/0', '{"v":[{"key":"arxiv","value":"9"},{"key":"openalex","value":"W5"}]}'),
        ('ids UA.SS', '1', '{"v":[{"key":"doi","value":"10/a"},{"key":"mag","value":"7"}]}'),
        ('ids UA.SS', '2', '{"v":[{"key":"arxiv","value":"1"},{"key":"doi","value":"10/a"}]}'),
        ('ids UA.SS', '3', '{"v":[{"key":"doi","value":"10/c"},{"key":"mag","value":"7"}]}'),
        ('ids UA.SS', '4', '{"v":[{"key":"openalex","value":"W5"}]}'),
        ('ids UA.SS', '5', '{}'),
        ('lookup', 'CR.4', '{"v":"doi:10/c"}'),
    ],
    "fx_index": [
        ('a', 'enriched', '{"v":"S1"}'),
        ('a', 'record', '{"v":{"author_0":"X","journal":"J, Journal"}}'),
        ('a', 'upsert', '{"v":{"title":"T","author":["X"],"journal":"J","journal_volume":"5","year":1999,"outcome":"filled"}}'),
        ('b', 'enriched', '{"v":"has"}'),
        ('b', 'record', '{"v":{}}'),
        ('b', 'upsert', '{"v":{"title":"B","year":2000,"outcome":"nothing_new"}}'),
        ('c', 'record', '{"v":{}}'),
        ('c', 'upsert', '{"v":{"title":"C","year":7,"outcome":"inserted"}}'),
        ('census', 'added', '{"v":2}'),
        ('census', 'not_good', '{"v":1}'),
        ('census', 'not_indexed', '{"v":1}'),
        ('census', 'present', '{"v":1}'),
        ('d', 'record', '{"v":{}}'),
        ('d', 'upsert', '{"v":{"year":8,"outcome":"too_little"}}'),
    ],
    "fx_citations": [
        ('0', 'short', '{"v":"Aa bb....jj kk"}'),
        ('0', 'split', '{"v":["Aa bb cc dd ee ff gg hh ii jj kk","Bb bb cc dd ee ff gg hh ii jj kk"]}'),
        ('0', 'valid', '{"v":true}'),
        ('1', 'short', '{"v":"Aa bb....jj kk"}'),
        ('1', 'split', '{"v":["Aa bb cc dd ee ff gg hh ii jj kkshort;","Bb bb cc dd ee ff gg hh ii jj kk"]}'),
        ('1', 'valid', '{"v":true}'),
        ('2', 'short', '{"v":"lead;....jj kk"}'),
        ('2', 'split', '{"v":["lead;","Aa bb cc dd ee ff gg hh ii jj kk"]}'),
        ('2', 'valid', '{"v":false}'),
        ('3', 'short', '{"v":"Aa bb.... tail"}'),
        ('3', 'split', '{"v":["Aa bb cc dd ee ff gg hh ii jj kktail;"]}'),
        ('3', 'valid', '{"v":true}'),
        ('4', 'short', '{"v":"only short"}'),
        ('4', 'split', '{"v":[]}'),
        ('4', 'valid', '{"v":false}'),
        ('5', 'short', '{"v":"doi o....; two"}'),
        ('5', 'split', '{"v":[]}'),
        ('5', 'valid', '{"v":false}'),
        ('6', 'short', '{"v":"Aa bb....jj kk"}'),
        ('6', 'split', '{"v":["Aa bb cc dd ee ff gg hh ii jj kk"]}'),
        ('6', 'valid', '{"v":true}'),
        ('7', 'short', '{}'),
        ('7', 'split', '{}'),
        ('7', 'valid', '{}'),
        ('p', '0', '{"v":{"plain_text":"xxxxxxxxxxxxxxxxxxxx","anystyle":"r0","status":"different_length_grobid"}}'),
        ('p', '1', '{"v":{"plain_text":"y","anystyle":"r1","status":"different_length_grobid"}}'),
        ('q', '0', '{"v":{"plain_text":"z","grobid":"h0","status":"no_anystyle"}}'),
    ],
    "fx_retrieval": [
        ('', 'normal', '{"v":"e-o"}'),
        ('', 'weights', '{"v":"{\'equal\': (1.0, 1.0), \'other\': (1.0, 0.0), \'none\': (0.5, 0.0)}"}'),
        ('by_id', 'x', '{"v":"2101.00001"}'),
        ('by_id', 'z', '{"v":"g"}'),
        ('clauses', 'integrate', '{"v":[{"fields":["author.0","author.1","author.2"],"text":"J. Bee"},{"fields":["author.0","author.1","author.2"],"text":"C. Dee"},{"fields":["author.0","author.1","author.2"],"text":"E. Eff"},{"fields":["journal_volume"],"text":"3"},{"fields":["title"],"text":"On drifts"},{"fields":["journal"],"text":"J. X"},{"fields":["year"],"text":"1999"}]}'),
        ('clauses', 'sentence', '{"v":[{"fields":["content","short_content"],"text":"whole text"}]}'),
        ('clauses', 'v21', '{"v":[{"fields":["author.0","author.1","author.2"],"text":"J. Bee"},{"fields":["author.0","author.1","author.2"],"text":"C. Dee"},{"fields":["author.0","author.1","author.2"],"text":"E. Eff"},{"fields":["jvol"],"text":"3"},{"fields":["title"],"text":"On drifts"},{"fields":["jname"],"text":"J. X"},{"fields":["year"],"text":"1999"}]}'),
        ('note', 'n', '{"v":"the_is_a_note"}'),
        ('ratio', '0', '{"v":62}'),
        ('ratio', '1', '{"v":100}'),
        ('ratio', '2', '{"v":0}'),
        ('ratio', '3', '{"v":0}'),
        ('ratio', '4', '{"v":0}'),
        ('search', 'c', '{"v":true}'),
        ('status', 'a', '{"v":"no_ref_text"}'),
        ('status', 'b', '{"v":"empty_ref_text"}'),
        ('status', 'c', '{"v":"no_ref_structured"}'),
        ('status', 'd', '{"v":"already_done"}'),
        ('status', 'e', '{"v":"pass"}'),
    ],
    "fx_grades": [
        ('check', '0', '{"v":"same"}'),
        ('check', '1', '{"v":"different"}'),
        ('check', '2', '{"v":"unchecked"}'),
        ('coverage', 'a', '{"v":{"hits":2,"coverage":"Full"}}'),
        ('coverage', 'b', '{"v":{"hits":1,"coverage":"Part"}}'),
        ('coverage', 'c', '{"v":{"hits":0,"coverage":"None"}}'),
        ('level', '1', '{"v":5}'),
        ('level', '10', '{"v":2}'),
        ('level', '2', '{"v":4}'),
        ('level', '3', '{"v":0}'),
        ('level', '4', '{"v":2}'),
        ('level', '5', '{"v":3}'),
        ('level', '6', '{"v":1}'),
        ('level', '7', '{"v":3}'),
        ('level', '8', '{"v":0}'),
        ('level', '9', '{"v":-1}'),
        ('p', 'a', '{"v":{"ratio":98,"known_id":"k1"}}'),
        ('q', 'd', '{"v":{"ratio":97,"known_id":"k3"}}'),
    ],
    "fx_batches": [
        ('', 'label', '{"v":{"pos":3,"paper_id":"1512.03385"}}'),
        ('', 'pretty', '{"v":"a ---> 1\\nb --->\\n    c ---> 2"}'),
        ('', 'rounds', '{"v":2}'),
        ('compared', 'a', '{"v":"gone"}'),
        ('compared', 'b', '{"v":"same"}'),
        ('compared', 'c', '{"v":"different"}'),
        ('compared', 'd', '{"v":"new"}'),
        ('counted', 'p', '{"v":"Pass"}'),
        ('counted', 'q', '{"v":"Fail"}'),
        ('counted', 'r', '{"v":"NoFile"}'),
        ('excluded', 'a', '{"v":true}'),
        ('presence', 'a', '{"v":false}'),
        ('presence', 'b', '{"v":true}'),
        ('presence', 'c', '{"v":true}'),
        ('read', 'a', '{"v":{"found":false}}'),
        ('read', 'b', '{"v":{"v":"2","found":true}}'),
        ('read', 'c', '{"v":{"v":"3","found":true}}'),
        ('remake', 'a', '{"v":true}'),
        ('shard', 'i0', '{"v":0}'),
        ('shard', 'i1', '{"v":0}'),
        ('shard', 'i2', '{"v":0}'),
        ('shard', 'i3', '{"v":1}'),
        ('shard', 'i4', '{"v":1}'),
        ('shard', 'i5', '{"v":1}'),
        ('shard', 'i6', '{"v":2}'),
        ('shard', 'i7', '{"v":2}'),
        ('shard', 'i8', '{"v":2}'),
        ('shard', 'i9', '{"v":2}'),
        ('tried', '4', '{"v":{"status":"Fail","failed":true}}'),
        ('tried', 'null', '{"v":{"status":"Skip","failed":false}}'),
        ('tried', 'x', '{"v":{"status":"NoNumber","failed":true}}'),
        ('unfinished', 'a', '{"v":true}'),
        ('updated', 'a', '{"v":"1"}'),
        ('updated', 'b', '{"v":"2"}'),
        ('updated', 'c', '{"v":"3"}'),
    ],
    "fx_colours": [
        ('', 'again', '{"v":[5,0,0]}'),
        ('', 'before', '{"v":true}'),
        ('', 'coloured', '{"v":"{\\\\color[RGB]{5,0,0}a} \\\\emph{{\\\\color[RGB]{5,0,5}bc}} ${\\\\color[RGB]{5,0,10}d}$"}'),
        ('', 'far', '{"v":3.0}'),
        ('', 'first', '{"v":[5,0,0]}'),
        ('', 'last', '{"v":[250,250,250]}'),
        ('', 'next_red', '{"v":[10,0,0]}'),
        ('', 'odd', '{"v":true}'),
        ('', 'plain', '{"v":false}'),
    ],
}
